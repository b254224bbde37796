import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from changetide import mapping
from changetide.operators import extent
from changetide.operators.filters import complete_hours_only
from changetide.operators.registry import compact_registry, load_fact, record_facts, registry_state, timestamp_fact
from changetide.operators.staging import add_content_key, parse_changes
from changetide.plans import queries
from changetide.schema import EVENT_COLUMNS
from changetide.sources import files
from changetide.sources.tables import append_changes, read_changes, read_registry
from conftest import change, rows_of

PLAIN = [f"2025-12-{d:02d}T{h:02d}:15:00Z" for d in (5, 9, 10, 11) for h in (0, 13)]
OFFSETS = ["2025-12-11T00:05:00+18:00", "2025-12-10T23:50:00-12:00", "2025-12-09T23:59:00-18:00", "2025-12-06T01:00:00+18:00"]
ODD = ["2099-01-01 odd", "2098-12-31 odd", "2098-12-30", "1900-01-01 odd", "garbage", None, "2025-99-99T00:00:00Z"]


@pytest.mark.parametrize("texts", [PLAIN, OFFSETS, PLAIN + OFFSETS + ODD, OFFSETS[:2] + ODD[:2], ODD[4:], ["2025-12-10 odd", "2025-12-09 odd", *OFFSETS[2:], *PLAIN[:1]]])
def test_extent_equals_a_full_scan(spark, tmp_path, texts):
    target = str(tmp_path / "table")
    lines = spark.createDataFrame([(json.dumps(change(i, dt=t)),) for i, t in enumerate(texts)], "value string")
    append_changes(add_content_key(parse_changes(lines)).select(*EVENT_COLUMNS), target)
    changes = read_changes(spark, target)
    want = changes.agg(F.min("ts_event_meta_dt").alias("min_ts"), F.max("ts_event_meta_dt").alias("max_ts"))
    assert rows_of(extent.stored_extent(spark, target)) == rows_of(want)
    assert rows_of(extent.stored_complete_hours(spark, target), "_h") == rows_of(complete_hours_only(changes), "_h")


def test_extent_reads_the_outermost_days(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "table")
    lines = spark.createDataFrame([(json.dumps(change(d, dt=f"2025-12-{d:02d}T01:00:00Z")),) for d in range(1, 29)], "value string")
    append_changes(add_content_key(parse_changes(lines)).select(*EVENT_COLUMNS), target)
    for file in files.children(spark, target):  # days in between are not opened: they may be gone
        if "event_date=2025-12-1" in file:
            files.drop(spark, file + "/wiki_group=enwiki")
    assert extent.outermost(spark, target, True) == dt.datetime(2025, 12, 28, 1)
    assert extent.outermost(spark, target, False) == dt.datetime(2025, 12, 1, 1)
    plan = read_changes(spark, target).where(F.col("event_date").isin([dt.date(2025, 12, 28)]))._jdf.queryExecution().executedPlan().toString()
    assert "2025-12-28" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_compact_registry_says_the_same(spark, tmp_path):
    path = str(tmp_path / "registry")
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "filename string")
    stats = spark.createDataFrame([("a", 5, 4), ("b", 7, 0)], "filename string, lines bigint, merged bigint")

    def at(hour):
        return dt.datetime(2026, 1, 1, hour)

    for step in (
        lambda: record_facts(timestamp_fact(names, "registered", at(3)), path),
        lambda: record_facts(load_fact(stats, at(9)), path),
        lambda: record_facts(timestamp_fact(names.limit(2), "registered", at(1)), path),
        lambda: record_facts(load_fact(stats.withColumn("merged", F.lit(1).cast("bigint")), at(8)), path),
        lambda: record_facts(timestamp_fact(names, "load_complete", at(11)), path),
    ):
        step()
        before = rows_of(registry_state(read_registry(spark, path)))
        compact_registry(spark, path)
        assert rows_of(registry_state(read_registry(spark, path))) == before
    assert read_registry(spark, path).count() == 3 + 3 + 2
    state = {r["filename"]: r for r in registry_state(read_registry(spark, path)).collect()}
    assert (state["b"]["loadstat_events_in_file"], state["b"]["loadstat_events_merged"], state["b"]["ts_load_end"]) == (7, 0, at(11))
    assert len([f for f in files.children(spark, path) if f.endswith(".parquet")]) < 5


def test_stored_tables_follow_the_data(spark, tmp_path):
    """Other data under the same path is not answered from what was written before."""
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for share in (4, 2):
        source.where(F.col("event_id") % share == 0).write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
        stored = queries.stored_table(spark, str(tmp_path))
        assert stored.count() == mapping.event_table(spark, str(tmp_path)).count()
        assert queries.dump_folder(spark, str(tmp_path)) == queries.dump_folder(spark, str(tmp_path))
