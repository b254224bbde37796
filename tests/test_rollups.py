import datetime as dt

import pytest
from pyspark.sql import functions as F

from changetide import mapping
from changetide.operators import filters
from changetide.operators.rollups import (
    both_hourly_counts,
    hourly_counts,
    refresh_rollups,
    rollup_consistency,
)
from changetide.sources.tables import append_changes, ensure_table, read_changes, read_rollup, read_rollups
from conftest import rows_of

FOLDER = "/root/testdata/sf0.001"


def events(spark, rows):
    """Rows of (time, wiki, type, bot)."""
    df = spark.createDataFrame(rows, "t string, event_wiki string, event_type string, event_bot boolean")
    return df.withColumn("ts_event_meta_dt", F.col("t").cast("timestamp")).drop("t")


def test_last_hour_is_cut_and_missing_values_are_groups(spark):
    df = events(
        spark,
        [
            ("2025-01-01 10:00:00", None, "edit", None),
            ("2025-01-01 10:59:59", None, "log", True),
            ("2025-01-01 11:00:00", "a", "edit", False),
            ("2025-01-01 12:00:00", "a", "log", False),
            (None, "a", "edit", True),
        ],
    )
    day = dt.date(2025, 1, 1)
    assert rows_of(hourly_counts(df)) == [(day, 10, None, 2, 1, 0), (day, 11, "a", 1, 0, 1)]
    # The newest event is no edit, but its hour is what counts.
    assert rows_of(hourly_counts(df, edits_only=True)) == [(day, 10, None, 1, 0, 0), (day, 11, "a", 1, 0, 1)]


def test_both_rollups_in_one_pass(spark):
    changes = mapping.event_table(spark, FOLDER)
    both = both_hourly_counts(filters.complete_hours_only(changes))
    for kind, edits_only in (("all", False), ("edits", True)):
        expected = rows_of(hourly_counts(changes, edits_only))
        assert rows_of(both.where(F.col("rollup") == kind).drop("rollup")) == expected


def test_refresh_after_each_part_equals_full_refresh(spark, tmp_path):
    changes = mapping.event_table(spark, FOLDER)
    target, out = str(tmp_path / "table"), str(tmp_path / "rollups")
    ensure_table(spark, target)
    t = F.col("ts_event_meta_dt")
    cuts = ["2024-01-10 05:30:00", "2024-01-10 23:10:00", "2024-01-20 00:00:00", "2025-01-01 00:00:00"]
    # Each part brings the events up to its time, and late ones of the days before it.
    late = F.coalesce(F.col("event_id") % 5 == 0, F.lit(False))
    before = "2000-01-01 00:00:00"
    for i, cut in enumerate(cuts):
        fresh = (t >= F.lit(before).cast("timestamp")) & (t < F.lit(cut).cast("timestamp"))
        part = changes.where(fresh & ~late if i < 3 else fresh | late)
        part = part.join(read_changes(spark, target).select("_h"), "_h", "left_anti")
        days = [r["d"] for r in part.select(F.to_date(t).alias("d")).distinct().collect()]
        append_changes(part, target)
        refresh_rollups(spark, target, out, days)
        stored = read_changes(spark, target)
        assert rows_of(read_rollup(spark, out)) == rows_of(
            hourly_counts(stored), *read_rollup(spark, out).columns
        )
        before = cut
    partial = rows_of(read_rollups(spark, out))
    refresh_rollups(spark, target, out)
    assert rows_of(read_rollups(spark, out)) == partial
    assert rollup_consistency(stored, read_rollup(spark, out)).first()["ok"]


def test_partial_refresh_reads_recent_and_touched_days_only(spark, tmp_path):
    changes = mapping.event_table(spark, FOLDER)
    target, out = str(tmp_path / "table"), str(tmp_path / "rollups")
    append_changes(changes, target)
    refresh_rollups(spark, target, out)
    before = {f for f in read_rollups(spark, out).inputFiles()}
    refresh_rollups(spark, target, out, [dt.date(2024, 1, 10)])
    after = {f for f in read_rollups(spark, out).inputFiles()}
    rewritten = {f.split("date=")[1][:10] for f in before - after}
    assert "2024-01-10" in rewritten and len(rewritten) <= 3


def test_rollup_consistency(spark):
    changes = mapping.event_table(spark, FOLDER)
    row = rollup_consistency(changes, hourly_counts(changes)).first()
    assert tuple(row) == (979, 979, True)
    assert not rollup_consistency(changes, hourly_counts(changes).limit(3)).first()["ok"]


def test_clamp_date_range():
    day = dt.date(2025, 1, 10)
    one = dt.timedelta(days=1)
    assert filters.clamp_date_range(day, day) == (day - one, day)
    assert filters.clamp_date_range(day + one, day) == (day - one, day)
    assert filters.clamp_date_range(day - one, day) == (day - one, day)


def test_filters_prune_partitions(spark, tmp_path):
    target = str(tmp_path / "table")
    append_changes(mapping.event_table(spark, FOLDER), target)
    changes = read_changes(spark, target)
    for df, expected in (
        (filters.wiki_filter(changes, "dewiki"), "wiki_group"),
        (filters.since_filter(changes, "2024-01-20"), "event_date"),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert expected in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert filters.wiki_filter(changes, "dewiki").count() == changes.where("event_wiki = 'dewiki'").count()
    since = changes.where("ts_event_meta_dt >= TIMESTAMP'2024-01-20'").count()
    assert filters.since_filter(changes, "2024-01-20").count() == since
    assert filters.since_filter(changes, None).count() == changes.count()


def test_filters_drop_or_keep_missing_values(spark):
    df = spark.createDataFrame(
        [("canary", "Talk:x", None), (None, None, True), ("d", "Template talk:x", False), ("d", "User:", False)],
        "event_meta_domain string, event_title string, event_bot boolean",
    )
    assert filters.drop_canary(df).count() == 3
    assert rows_of(filters.exclude_title_prefixes(df), "event_title") == [("Template talk:x",)]
    assert filters.exclude_title_prefixes(df, ["T"]).count() == 1
    assert filters.exclude_bots(df).count() == 2


def test_known_wikis(spark):
    available = spark.createDataFrame([("b",), ("a",), (None,)], "event_wiki string")
    assert filters.require_known_wikis(["x", "a", "b"], available) == ["a", "b"]
    with pytest.raises(ValueError):
        filters.require_known_wikis(["x"], available)
