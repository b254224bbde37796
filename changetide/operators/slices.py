"""Output slices: a new one at five past each hour, and after half a million events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from changetide.functions.columns import micros
from changetide.operators.filters import TS
from changetide.schema import MAX_EVENTS_PER_SLICE, SLICE_START_MINUTE


def with_slice_start(changes: DataFrame) -> DataFrame:
    """Adds `slice_start`: five past the hour at or before the event."""
    shift = F.make_dt_interval(mins=F.lit(SLICE_START_MINUTE))
    start = F.date_trunc("HOUR", F.col(TS).cast("timestamp") - shift) + shift
    return changes.withColumn("slice_start", start)


def count_slices(changes: DataFrame) -> DataFrame:
    """Events per slice: slice_start, events."""
    return with_slice_start(changes).groupBy("slice_start").agg(F.count(F.lit(1)).alias("events"))


def dump_slices(
    changes: DataFrame, max_events: int = MAX_EVENTS_PER_SLICE, before: DataFrame | None = None
) -> DataFrame:
    """Adds `slice_start` and `slice_part`, each part holding at most `max_events` events.

    `before` (slice_start, events) tells how many events slices have already; numbering goes on from there.

    Event time stands in for the wall clock of the writer. Events are numbered by second, and by
    content key within it; `changes` is the event table, whose keys are unique. The numbering is
    done in cells of one second and one of 256 key ranges, to which the counts of the cells before
    are added, so that an hour holding most events is numbered by many tasks.
    """
    if max_events < 1:
        raise ValueError("a slice must hold at least one event")
    none = F.lit(-(2**62))
    cells = with_slice_start(changes).withColumns(
        {
            "_slice": F.coalesce(micros(F.col("slice_start")), none),
            "_second": F.coalesce(F.unix_seconds(F.col(TS).cast("timestamp")), none),
            "_range": F.substring("_h", 1, 2),
        }
    )
    cell = ["_slice", "_second", "_range"]
    earlier = (
        Window.partitionBy("_slice")
        .orderBy("_second", "_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # A slice has at most 3600 seconds of 256 cells.
    starts = (
        cells.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*cell, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    if before is not None:
        given = before.select(F.coalesce(micros(F.col("slice_start")), none).alias("_slice"), "events")
        starts = starts.join(given, "_slice", "left").select(
            *cell, (F.col("_start") + F.coalesce("events", F.lit(0))).alias("_start")
        )
    number = F.row_number().over(Window.partitionBy(*cell).orderBy("_h"))
    numbered = cells.withColumn("_number", number).join(starts, cell)
    position = F.col("_start") + F.col("_number") - 1
    part = ((position - position % F.lit(max_events)) / F.lit(max_events)).cast("bigint")
    return numbered.withColumn("slice_part", part).drop(*cell, "_number", "_start")
