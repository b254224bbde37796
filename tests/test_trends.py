import datetime as dt

import pytest
from pyspark.sql import functions as F

from changetide import mapping
from changetide.operators import trends
from changetide.operators.rollups import hourly_counts
from conftest import rows_of
from test_rollups import FOLDER, events


def edits(spark, *times, wiki="w", title="P"):
    df = spark.createDataFrame([(t,) for t in times], "t string")
    return df.select(
        F.col("t").cast("timestamp").alias("ts_event_meta_dt"),
        F.lit("edit").alias("event_type"),
        F.lit(wiki).alias("event_wiki"),
        F.lit(title).alias("event_title"),
    )


def hour(h, day=1):
    return dt.datetime(2025, 1, day, h)


def series(df):
    return [(r["t"], r["value"]) for r in df.withColumn("t", F.col("t").cast("timestamp_ntz")).collect()]


def test_gaps_are_filled_between_first_and_last_edit(spark):
    df = edits(spark, "2025-01-01 10:59:00", "2025-01-01 13:00:00", "2025-01-01 13:01:00", None)
    filled = [(hour(10), 1), (hour(11), 0), (hour(12), 0), (hour(13), 2)]
    assert series(trends.page_history_filled(df, "w", "P")) == filled
    with_mark = series(trends.page_history_filled(df, "w", "P", fill=-10))
    assert [v for _, v in with_mark] == [1, -10, -10, 2]


def test_bounds_of_the_series(spark):
    df = edits(spark, "2025-01-01 10:59:00", "2025-01-01 13:00:00")
    history = trends.page_history_filled
    assert series(history(df, "w", "P", tmin=hour(12))) == [(hour(12), 0), (hour(13), 1)]
    assert series(history(df, "w", "P", tmax=hour(11))) == [(hour(10), 1), (hour(11), 0)]
    day = series(history(df, "w", "P", tmin=dt.date(2025, 1, 1), tmax=dt.date(2025, 1, 2)))
    assert len(day) == 25 and sum(v for _, v in day) == 2
    # Steps keep the minutes of the lower bound: 11:30, 12:30, and 13:30 is past 13:15.
    odd = history(df, "w", "P", tmin=hour(11).replace(minute=30), tmax=hour(13).replace(minute=15))
    assert series(odd) == [(hour(11), 0), (hour(12), 0)]
    assert series(history(df, "w", "P", tmin=hour(14), tmax=hour(12))) == []


def test_page_without_edits(spark):
    df = edits(spark, "2025-01-01 10:59:00")
    assert series(trends.page_history_filled(df, "w", "Q")) == []
    assert series(trends.page_history_filled(df, "w", "Q", hour(1), hour(2))) == [(hour(1), 0), (hour(2), 0)]


@pytest.mark.parametrize("bound", ["2025-01-01", 5])
def test_bound_must_be_a_date(spark, bound):
    df = edits(spark, "2025-01-01 10:59:00")
    with pytest.raises(ValueError):
        trends.page_history_filled(df, "w", "P", tmin=bound)
    with pytest.raises(ValueError):
        trends.page_history(df, [("w", "P", bound, None)])


def test_many_series_in_one_job(spark):
    df = edits(spark, "2025-01-01 10:00:00", "2025-01-01 12:00:00").unionByName(
        edits(spark, "2025-01-01 05:00:00", title="Q")
    )
    pages = [("w", "P"), ("w", "Q", None, hour(6)), ("w", "P", hour(12), None), ("w", "none")]
    got = trends.page_history(df, pages).withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert rows_of(got) == sorted(
        [
            (0, "w/P", hour(10), 1),
            (0, "w/P", hour(11), 0),
            (0, "w/P", hour(12), 1),
            (1, "w/Q", hour(5), 1),
            (1, "w/Q", hour(6), 0),
            (2, "w/P", hour(12), 1),
        ],
        key=repr,
    )
    by_rows = trends.page_history(df, trends.page_specs(df, pages)).withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert rows_of(by_rows) == rows_of(got)


def test_history_scans_the_events_once(spark):
    changes = mapping.event_table(spark, FOLDER)
    df = trends.page_history(changes, [("wikidatawiki", "Page 51")])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1


def test_top_pages_history_has_ranks_and_a_common_axis(spark):
    changes = mapping.event_table(spark, FOLDER)
    day = dt.date(2024, 1, 9)
    got = trends.top_pages_history(changes, "enwiki", None, day, dt.datetime(2024, 1, 9, 5), first=3)
    assert {r["series_no"]: r["n"] for r in got.groupBy("series_no").agg(F.count("*").alias("n")).collect()} == {
        0: 6,
        1: 6,
        2: 6,
    }
    first = trends.top_pages(changes, "enwiki").first()["event_title"]
    assert got.where("series_no = 0").first()["series"] == f"enwiki/{first}"


def test_hours_with_only_bot_edits(spark):
    df = events(
        spark,
        [
            ("2025-01-01 10:00:00", "a", "edit", True),
            ("2025-01-01 10:10:00", "b", "edit", False),
            ("2025-01-01 11:10:00", "a", "edit", True),
            ("2025-01-01 12:10:00", "c", "edit", False),
            ("2025-01-01 13:10:00", "a", "edit", False),
        ],
    )
    rollup = hourly_counts(df, edits_only=True)
    no_bots = dict(wikis=["a", "b"], with_bots=False)
    assert [tuple(r)[1:4] for r in trends.timetrend_raw(df, **no_bots).collect()] == [(10, None, 1)]
    assert [tuple(r)[1:4] for r in trends.timetrend_rollup(rollup, **no_bots).collect()] == [
        (10, 0, 1),
        (11, 0, None),
    ]
    both = [tuple(r)[1:4] for r in trends.timetrend_raw(df, ["a", "b"]).collect()]
    assert both == [(10, 1, 1), (11, 1, None)]
    assert both == [tuple(r)[1:4] for r in trends.timetrend_rollup(rollup, ["a", "b"]).collect()]


def test_trend_columns_are_named_by_wiki_in_request_order(spark):
    df = events(spark, [("2025-01-01 10:00:00", "a-b", "edit", True)])
    assert trends.timetrend_raw(df, ["z.x", "a-b"]).columns == ["date", "hour", "z.x", "a-b", "ts"]


def test_daily_rate_of_edits_is_missing_without_edits(spark):
    df = events(
        spark,
        [
            ("2025-01-01 10:00:00", "a", "log", True),
            ("2025-01-02 10:00:00", "a", "edit", True),
            ("2025-01-02 10:00:00", "a", "log", True),
        ],
    )
    rows = [tuple(r) for r in trends.daily_rates(df).collect()]
    assert rows == [
        (dt.date(2025, 1, 2), 2 / 86400.0, 1 / 86400.0),
        (dt.date(2025, 1, 1), 1 / 86400.0, None),
    ]


def test_ties_are_broken_by_name_and_a_missing_name_is_last(spark):
    df = events(spark, [("2025-01-01 10:00:00", w, "edit", True) for w in ("b", None, "a", "c", "c")])
    assert [r["event_wiki"] for r in trends.top_wikis(df).collect()] == ["c", "a", "b", None]
    assert [r["event_wiki"] for r in trends.top_wikis(df, 2).collect()] == ["c", "a"]


def test_an_odd_year_does_no_harm(spark):
    """A page with events thousands of years apart: the axis is laid out in blocks."""
    span = spark.createDataFrame([(0, "w", "t", "0001-01-01 00:30:00", "2024-01-01 00:00:00")], "series_no int, event_wiki string, event_title string, lo string, hi string")
    span = span.withColumns({c: F.col(c).cast("timestamp") for c in ("lo", "hi")})
    hours = trends._hours(span)
    assert hours.count() == (dt.datetime(2024, 1, 1) - dt.datetime(1, 1, 1)).days * 24
    assert hours.agg(F.count_distinct("t")).first()[0] == hours.count()


def test_history_reads_only_its_days(spark, tmp_path):
    from changetide.sources.tables import append_changes, read_table

    target = str(tmp_path / "table")
    append_changes(mapping.event_table(spark, FOLDER), target)
    history = trends.page_history(read_table(spark, target), [("enwiki", "Page 1")], dt.date(2024, 1, 8), dt.date(2024, 1, 9))
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert history.count() == 25
