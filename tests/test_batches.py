import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from changetide.operators.slices import dump_slices
from changetide.plans.queries import in_turn
from changetide.streaming import batches, health, jobs
from conftest import rows_of

SCHEMA = "_h string, ts_event_meta_dt timestamp, batch string"
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def events(spark, seconds, first=0):
    """Events so many seconds after ten o'clock, None for one without a time."""
    rows = [(f"{(first + i) * 7919 % 65536:04x}", None if s is None else T0 + dt.timedelta(seconds=s), "x") for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, SCHEMA)


def times(frame):
    return sorted(r["ts_event_meta_dt"] for r in frame.select("ts_event_meta_dt").collect())


def test_slices_of_several_batches(spark, tmp_path):
    """Parts go on over batches, over slices and over batches that a slice shares; two runs, one checkpoint."""
    seconds = [s for s in range(0, 9000, 40) for _ in range(3)] + [None] * 5
    whole = events(spark, seconds)
    parts = [whole.where(F.col("ts_event_meta_dt") < F.lit(T0 + dt.timedelta(seconds=4000)))]
    parts.append(whole.where(F.col("ts_event_meta_dt") >= F.lit(T0 + dt.timedelta(seconds=4000))).where(F.col("ts_event_meta_dt") < F.lit(T0 + dt.timedelta(seconds=7000))))
    parts.append(whole.where("ts_event_meta_dt IS NULL"))
    parts.append(whole.where(F.col("ts_event_meta_dt") >= F.lit(T0 + dt.timedelta(seconds=7000))))
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    for chunk in (parts[:2], parts[2:]):
        for part in chunk:
            part.coalesce(1).write.mode("append").parquet(source)
        batches.stream_dump_slices(stream, out, state, 7).awaitTermination()
    columns = ["_h", "slice_start", "slice_part"]
    got = batches.sliced(spark, out, stream.schema)
    assert rows_of(got, *columns) == rows_of(dump_slices(whole, 7), *columns)
    assert got.groupBy("slice_start", "slice_part").count().agg(F.max("count")).first()[0] == 7
    assert batches.late_table(spark, out + "-late", stream.schema).count() == 0


def test_slice_state_is_dropped_and_late_events_are_kept_aside(spark, tmp_path):
    parts = [events(spark, [0, 10, 20]), events(spark, [5 * 3600], 10), events(spark, [30, 5 * 3600 + 1, 2 * 3600, 4 * 3600], 20)]
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream = in_turn(spark, parts)
    batches.stream_dump_slices(stream, out, state, 2).awaitTermination()
    late = batches.late_table(spark, out + "-late", stream.schema)
    assert times(late) == [T0 + dt.timedelta(seconds=s) for s in (30, 2 * 3600)]
    kept = batches.Versions(state + "-counts", "slice_start timestamp, events bigint").before(spark, 3)
    assert times(kept.withColumnRenamed("slice_start", "ts_event_meta_dt")) == [T0 + dt.timedelta(hours=h, minutes=5) for h in (3, 4)]
    assert batches.sliced(spark, out, stream.schema).count() == 6
    with pytest.raises(ValueError):
        batches.stream_dump_slices(stream, out, state, keep=dt.timedelta(minutes=59))


def test_late_rows_are_exact_beyond_the_remembered_progress(spark, tmp_path):
    """More batches than Spark remembers; every second one is late but for one row."""
    name, remembered = "spark.sql.streaming.numRecentProgressUpdates", 3
    before = spark.conf.get(name)
    spark.conf.set(name, str(remembered))
    try:
        parts = [events(spark, [7200 * n] if n % 2 == 0 else [7200 * n - 12000, 7200 * n - 3600 - 7200, 7200 * n, None], 10 * n) for n in range(12)]
        seen = {}
        late, state = str(tmp_path / "late"), str(tmp_path / "state")
        stream = in_turn(spark, parts)
        query = batches.stream_split_late(stream, lambda rows, n: seen.update({n: rows.count()}), late, state)
        query.awaitTermination()
        assert query.exception() is None and len(query.recentProgress) <= remembered
    finally:
        spark.conf.set(name, before)
    assert [seen[n] for n in range(12)] == [1, 2] * 6
    want = [T0 + dt.timedelta(seconds=7200 * n - s) for n in range(1, 12, 2) for s in (12000, 10800)]
    assert times(batches.late_table(spark, late, stream.schema)) == sorted(want)
    assert jobs.late_rows(query) == 0  # no operator of Spark has dropped any


def test_a_batch_that_is_run_again_replaces_its_rows(spark, tmp_path):
    late, out, folder = (str(tmp_path / n) for n in ("late", "out", "versions"))
    newest = batches.Versions(folder, "newest timestamp")
    counts = batches.Versions(folder + "2", "slice_start timestamp, events bigint")
    number = lambda rows, n: batches.number_slices(rows, n, out, counts, 2, dt.timedelta(hours=3))
    for n, seconds in [(0, [4000]), (1, [4001, 10]), (1, [4001, 10]), (2, [4002, 20]), (2, [4002, 20])]:
        batches.split_late(events(spark, seconds, 10 * n), n, number, late, newest, dt.timedelta(hours=1))
    assert batches.late_table(spark, late, SCHEMA).count() == 2
    parts = spark.read.schema(SCHEMA + ", slice_start timestamp, slice_part bigint").parquet(out)
    assert rows_of(parts, "slice_part") == [(0,), (0,), (1,)]


def test_health_turns_by_time(spark, tmp_path):
    """OK by an event, ERROR with no further one, OK again by the next: the state changes over three triggers and more."""
    source, name = str(tmp_path / "in"), "health_turns"
    events(spark, []).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    changes = health.stream_health_timeout(stream, max_age=2, source="s")
    writer = changes.writeStream.format("memory").queryName(name).outputMode("append")
    query = writer.option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="200 milliseconds").start()

    def changed(times):
        return [(r["source"], r["status"], r["last_event"] and (r["last_event"] - T0).total_seconds()) for r in spark.table(name).collect()][:times]

    def wait(times):
        end = time.time() + 90
        while len(changed(times)) < times and time.time() < end and query.isActive:
            time.sleep(0.1)
        return changed(times)

    try:
        assert changed(9) == [] and health.last_status([]) == "ERROR"
        events(spark, [60, 5, None]).coalesce(1).write.mode("append").parquet(source)
        assert wait(2) == [("s", "OK", 60.0), ("s", "ERROR", 60.0)]
        events(spark, [30]).coalesce(1).write.mode("append").parquet(source)
        assert wait(4)[2:] == [("s", "OK", 60.0), ("s", "ERROR", 60.0)]
        assert health.last_status([c[:2] for c in changed(9)], "s") == "ERROR"
    finally:
        query.stop()
    assert query.exception() is None


def test_heartbeats_are_few(spark):
    seen = health.heartbeats(spark.range(50_000).select(F.timestamp_seconds("id").alias("ts_event_meta_dt")).repartition(3), "s").collect()
    assert len(seen) <= 9 and max(r["newest"] for r in seen) == dt.datetime(1970, 1, 1, 13, 53, 19)
