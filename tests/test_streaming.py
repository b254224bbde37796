import datetime as dt

import pytest
from pyspark.sql import functions as F

from changetide import mapping
from changetide.operators.registry import registry_state
from changetide.operators.retention import new_dumps
from changetide.operators.rollups import hourly_counts
from changetide.operators.staging import dedup_changes
from changetide.plans.queries import event_stream
from changetide.sources import dumps
from changetide.sources.tables import read_changes, read_registry, read_rollup
from changetide.streaming import jobs
from conftest import change, rows_of
from test_rollups import FOLDER

A = "stream_20251213T180500_000001.gz.ready"
B = "stream_20251213T190500_000002.gz.ready"


def test_stream_load_resumes_and_takes_closed_dumps_only(spark, write_dump, tmp_path):
    folder, target = str(tmp_path / "dumps"), str(tmp_path / "table")
    registry, state = str(tmp_path / "registry"), str(tmp_path / "state")
    rollups = str(tmp_path / "rollups")
    write_dump(A, [change(1), change(1), change(2), "{bad", change(3, domain="canary")])
    write_dump("stream_20251213T190500_000002.gz", [change(99)])

    def run():
        jobs.stream_load(spark, folder, target, state, registry, rollups).awaitTermination()
        return rows_of(read_changes(spark, target), "event_meta_id")

    assert run() == [("m1",), ("m2",)]
    assert run() == [("m1",), ("m2",)]
    write_dump(B, [change(2), change(4), change(5, dt="2025-12-13T19:30:00Z")])
    assert run() == [("m1",), ("m2",), ("m4",), ("m5",)]
    counts = registry_state(read_registry(spark, registry))
    assert rows_of(counts, "filename", "loadstat_events_in_file", "loadstat_events_merged") == [(A, 5, 2), (B, 3, 2)]
    expected = hourly_counts(read_changes(spark, target))
    assert rows_of(read_rollup(spark, rollups), *expected.columns) == rows_of(expected)
    # A lost checkpoint means every dump is read again; nothing is added.
    jobs.stream_load(spark, folder, target, str(tmp_path / "state2")).awaitTermination()
    assert read_changes(spark, target).count() == 4


def run_to_rows(spark, stream, tmp_path):
    out = str(tmp_path / "out")
    jobs.run_to_folder(stream, out, str(tmp_path / "state"))
    return spark.read.schema(stream.schema).parquet(out)


def test_stream_counts_equal_the_rollup_of_closed_hours(spark, tmp_path):
    events = dedup_changes(mapping.keyed(spark, FOLDER))
    got = run_to_rows(spark, jobs.stream_hourly_counts(event_stream(spark, FOLDER), "0 seconds"), tmp_path)
    assert rows_of(got) == rows_of(hourly_counts(events))


@pytest.mark.parametrize("salts", [1, 8])
def test_stream_dedup(spark, tmp_path, salts):
    got = run_to_rows(spark, jobs.stream_dedup(event_stream(spark, FOLDER), salts=salts), tmp_path)
    assert rows_of(got, "_h") == rows_of(mapping.keyed(spark, FOLDER).select("_h").distinct())


def test_watching_a_user_in_dumps(spark, write_dump, tmp_path):
    write_dump(A, [change(1, user="x"), change(2), change(3, user=None), change(4, user="x", domain="canary")])
    lines = dumps.stream_dumps(spark, str(tmp_path / "dumps"))
    got = run_to_rows(spark, jobs.stream_watch_user(jobs.keyed_events(lines), "x"), tmp_path)
    assert rows_of(got, "event_meta_id") == [("m1",)]


def test_health_of_a_running_query(spark, tmp_path):
    stream = event_stream(spark, FOLDER).withWatermark("ts_event_meta_dt", "1 hour")
    query = (
        stream.writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    newest = mapping.keyed(spark, FOLDER).agg(F.max("ts_event_meta_dt").cast("timestamp_ntz")).first()[0]
    assert jobs.query_health(query, newest + dt.timedelta(seconds=900)) == "OK"
    assert jobs.query_health(query, newest + dt.timedelta(seconds=902)) == "ERROR"


def test_stream_load_bookkeeping(spark, write_dump, tmp_path):
    """A dump without lines is recorded, and a fresh checkpoint at the old path merges nothing."""
    folder, target, registry = (str(tmp_path / n) for n in ("dumps", "table", "registry"))
    write_dump(A, [change(1), change(2)])
    write_dump(B, [])
    for state in ("one", "two"):
        jobs.stream_load(spark, folder, target, str(tmp_path / state), registry).awaitTermination()
        counts = registry_state(read_registry(spark, registry))
        merged = 2 if state == "one" else 0
        assert rows_of(counts, "filename", "loadstat_events_in_file", "loadstat_events_merged") == [(A, 2, merged), (B, 0, 0)]
        assert counts.where("ts_load_begin IS NULL OR ts_load_begin > ts_load_end").count() == 0
    files = dumps.list_dumps(spark, folder).select("filename")
    assert new_dumps(files, read_registry(spark, registry)).count() == 0


def test_late_rows_are_reported(spark, tmp_path):
    folder, out = tmp_path / "events", str(tmp_path / "out")
    times = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-01 00:30:00"]
    table = spark.createDataFrame([(str(i), t) for i, t in enumerate(times)], "_h string, ts string")
    table = table.withColumn("ts_event_meta_dt", F.col("ts").cast("timestamp"))
    for i in range(3):
        table.where(F.col("_h") == str(i)).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    query = jobs.run_to_folder(jobs.stream_dedup(stream, salts=1), out, str(tmp_path / "state"))
    kept = spark.read.parquet(out).count()
    assert kept + jobs.late_rows(query) == 3
