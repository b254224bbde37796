import pytest
from pyspark.sql import functions as F

from changetide.operators import breakdown
from conftest import rows_of


def rollup(spark, rows):
    """Rows of (wiki, all, bots, not bots)."""
    df = spark.createDataFrame(
        rows, "event_wiki string, count_bot_flagignore bigint, count_bot_true bigint, count_bot_false bigint"
    )
    return df.withColumn("date", F.lit("2025-01-01").cast("date"))


def test_running_sums_by_size_then_name_missing_name_last(spark):
    df = rollup(spark, [(None, 2, 0, 2), ("b", 2, 1, 1), ("a", 2, 0, 2), ("c", 4, 4, 0)])
    rows = [tuple(r) for r in breakdown.wiki_breakdown(df).orderBy("cumsum").collect()]
    assert rows == [
        ("c", 4, 0.4, 4, 0.4, 10, 10),
        ("a", 2, 0.2, 6, 0.6, 10, 10),
        ("b", 2, 0.2, 8, 0.8, 10, 10),
        (None, 2, 0.2, 10, 1.0, 10, 10),
    ]


def test_without_bots_the_shares_have_different_totals(spark):
    df = rollup(spark, [("a", 6, 3, 3), ("b", 4, 3, 1)])
    rows = [tuple(r) for r in breakdown.wiki_breakdown(df, with_bots=False).orderBy("cumsum").collect()]
    assert rows == [("a", 3, 0.3, 3, 0.75, 10, 4), ("b", 1, 0.1, 4, 1.0, 10, 4)]


@pytest.mark.parametrize(
    "counts, labels",
    [
        # Exactly 95 percent is reached: the wiki reaching it goes to the tail.
        ([("a", 80), ("b", 15), ("c", 5)], {"a", "other wikis"}),
        ([("a", 80), ("b", 14), ("c", 6)], {"a", "b", "other wikis"}),
        ([("a", 100)], {"other wikis"}),
    ],
)
def test_tail_label(spark, counts, labels):
    df = rollup(spark, [(w, n, 0, n) for w, n in counts])
    segments = breakdown.breakdown_segments(breakdown.wiki_breakdown(df))
    assert {r["event_wiki"] for r in segments.collect()} == labels
    assert abs(sum(r["rel_sum"] for r in segments.collect()) - 1) < 1e-12


def test_missing_wiki_counts_in_totals_and_may_be_in_the_tail(spark):
    tail = breakdown.wiki_breakdown(rollup(spark, [("a", 99, 0, 0), (None, 1, 0, 0)]))
    assert rows_of(breakdown.breakdown_segments(tail), "event_wiki", "rel_sum") == [("other wikis", 1.0)]
    large = breakdown.wiki_breakdown(rollup(spark, [(None, 50, 0, 0), ("a", 50, 0, 0)]))
    assert rows_of(breakdown.breakdown_segments(large), "event_wiki", "rel_sum") == [("a", 0.5), ("other wikis", 0.5)]
    dropped = breakdown.wiki_breakdown(rollup(spark, [(None, 60, 0, 0), ("a", 40, 0, 0)]))
    assert rows_of(breakdown.breakdown_segments(dropped)) == [("other wikis", 0.4)]


def test_empty_rollup(spark):
    assert breakdown.wiki_breakdown(rollup(spark, [])).count() == 0
    zero = breakdown.wiki_breakdown(rollup(spark, [("a", 1, 1, 0)]), with_bots=False).first()
    assert zero["rel_cumsum"] is None


def test_start_date(spark):
    df = rollup(spark, [("a", 1, 0, 0)])
    assert breakdown.breakdown_sums(df, "2025-01-01").count() == 1
    assert breakdown.breakdown_sums(df, "2025-01-02").count() == 0
    totals = breakdown.breakdown_totals(breakdown.breakdown_sums(df))
    assert tuple(totals.first()) == (1, 0, 0)
