"""Micro-batches with a small state of their own: rows that come too late, and continuous slices.

The state of a query is a table of a few rows a version, and each batch writes the version after its own. A
batch that is run again after a crash starts from the version before it and replaces what it wrote, so
every row comes out once. Rows are split and numbered by many tasks; only the state is small.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from changetide.operators.filters import TS
from changetide.operators.slices import count_slices, dump_slices
from changetide.schema import MAX_EVENTS_PER_SLICE
from changetide.sources import files

Handler = Callable[[DataFrame, int], None]


class Versions:
    """A small table in versions, one a batch."""

    def __init__(self, folder: str, schema: str):
        self.folder, self.schema = folder.rstrip("/"), schema

    def _path(self, batch: int) -> str:
        return f"{self.folder}/version={batch:012d}"

    def _whole(self, spark: SparkSession) -> list[int]:
        """Versions that were written to their end."""
        named = [f for f in files.children(spark, self.folder) if "/version=" in f]
        return [int(f.rsplit("=", 1)[1]) for f in named if files.exists(spark, f"{f}/_SUCCESS")]

    def before(self, spark: SparkSession, batch: int) -> DataFrame:
        """The state that a batch starts from; empty for the first."""
        found = [v for v in self._whole(spark) if v < batch]
        return spark.read.schema(self.schema).parquet(self._path(max(found))) if found else spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame, batch: int) -> None:
        """The state after a batch. The version before it stays, as the batch may be run again."""
        spark = rows.sparkSession
        rows.coalesce(1).write.mode("overwrite").parquet(self._path(batch))
        for old in sorted(v for v in self._whole(spark) if v < batch)[:-1]:
            files.drop(spark, self._path(old))


def batch_folder(target: str, batch: int) -> str:
    return f"{target.rstrip('/')}/batch={batch}"


def split_late(rows: DataFrame, batch: int, handle: Handler, late: str, state: Versions, delay: dt.timedelta) -> None:
    """Write the rows of a batch that come too late to a side table, and hand on the others.

    Late is what is not newer than the watermark: the newest time of all batches before, less `delay`. Rows without
    a time are not late. The state is that newest time.
    """
    spark = rows.sparkSession
    rows = rows.persist()
    try:
        newest = state.before(spark, batch).agg(F.max("newest").alias("t")).first()["t"]
        is_late = F.coalesce(F.col(TS) <= F.lit(newest - delay), F.lit(False)) if newest else F.lit(False)
        rows.where(is_late).write.mode("overwrite").parquet(batch_folder(late, batch))
        handle(rows.where(~is_late), batch)
        state.write(rows.agg(F.greatest(F.max(TS), F.lit(newest).cast("timestamp")).alias("newest")), batch)
    finally:
        rows.unpersist()


def stream_split_late(
    events: DataFrame, handle: Handler, late: str, checkpoint: str, delay: dt.timedelta = dt.timedelta(hours=1)
) -> StreamingQuery:
    """Start a query that gives `handle` what comes in time, by batches, and keeps in `late` each row that does not.

    `handle(rows, batch)` has to replace what it wrote if a batch comes again. The number of late rows is that
    of the side table (`late_table`), exact however long the query runs.
    """
    state = Versions(f"{checkpoint.rstrip('/')}-newest", "newest timestamp")

    def each(rows: DataFrame, batch: int) -> None:
        split_late(rows, batch, handle, late, state, delay)

    return events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_table(spark: SparkSession, late: str, schema) -> DataFrame:
    """Rows that came too late; `schema` is that of the stream."""
    return spark.read.schema(schema).parquet(late)


def number_slices(
    rows: DataFrame, batch: int, target: str, state: Versions, max_events: int, keep: dt.timedelta
) -> None:
    """Number the rows of a batch on from what their slices have already, and write them.

    The state is the number of events per slice, of slices that began at most `keep` before the newest one.
    """
    spark = rows.sparkSession
    rows = rows.persist()
    try:
        before = state.before(spark, batch)
        dump_slices(rows, max_events, before).write.mode("overwrite").parquet(batch_folder(target, batch))
        counts = before.unionByName(count_slices(rows)).groupBy("slice_start").agg(F.sum("events").alias("events"))
        newest = counts.agg(F.max("slice_start")).scalar()
        state.write(counts.where(F.col("slice_start").isNull() | (F.col("slice_start") >= newest - F.lit(keep))), batch)
    finally:
        rows.unpersist()


def stream_dump_slices(
    events: DataFrame,
    target: str,
    checkpoint: str,
    max_events: int = MAX_EVENTS_PER_SLICE,
    keep: dt.timedelta = dt.timedelta(hours=3),
    late: str | None = None,
) -> StreamingQuery:
    """Cut a stream into slices: a new one at five past each hour, and after `max_events` events.

    Adds `slice_start` and `slice_part`, and writes by batches to `target` (`sliced`). Events are numbered in the
    order of batches, and within one by time; a stream in order of time whose batches end between two
    seconds gives what `dump_slices` gives for all of it. Events more than `keep`, less the hour a slice lasts,
    behind the newest of earlier batches have no slice any more: they go to the side table `late`
    (by default beside the target), as `split_late` does it. Events without a time are a slice.
    """
    base = checkpoint.rstrip("/")
    counts = Versions(f"{base}-counts", "slice_start timestamp, events bigint")
    newest = Versions(f"{base}-newest", "newest timestamp")
    delay = keep - dt.timedelta(hours=1)
    if delay < dt.timedelta(0):
        raise ValueError("a slice has to be kept for its hour")

    def each(rows: DataFrame, batch: int) -> None:
        number = lambda kept, n: number_slices(kept, n, target, counts, max_events, keep)
        split_late(rows, batch, number, late or f"{target.rstrip('/')}-late", newest, delay)

    return events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sliced(spark: SparkSession, target: str, schema) -> DataFrame:
    """What `stream_dump_slices` has written; `schema` is that of the stream."""
    whole = spark.createDataFrame([], schema).selectExpr("*", "CAST(NULL AS TIMESTAMP) AS slice_start", "CAST(NULL AS BIGINT) AS slice_part")
    return spark.read.schema(whole.schema).parquet(target)
