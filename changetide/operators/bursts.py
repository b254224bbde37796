"""Densest interval: how many events lie within S seconds of each event.

Neither the interval count nor its peak may put all events, or all of a busy quarter of an hour,
into one task, and a sliding RANGE frame would add up its whole frame for every row. So:

* equal times are counted first, on both sides of the shuffle;
* time is cut into one-second tiles; a tile has at most a million distinct microseconds;
* the count in [t - S, t] is the count of the S tiles before t's tile (from per-tile counts) minus
  the events of tile - S that are earlier than t - S, plus those of t's own tile up to t. Events are
  therefore sent to their own tile with weight +1 and, S seconds later, with weight -1, and one
  running sum per tile gives the rest.

The peak needs less: per-tile counts bound the count of every window from both sides up to the
events of one tile, so only the few tiles that can hold the peak are looked at closely.

Counts per second can be kept (`second_counts`, added up by `merge_second_counts`): from them alone
follows which seconds can hold the peak, and only the days around these are read again.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from changetide.functions.columns import micros
from changetide.schema import BURST_SECONDS

_TILE = 1_000_000
# Rows written out by one generator row when equal times are listed one by one again.
_CHUNK = 100_000


def _checked_seconds(seconds: int) -> int:
    if not isinstance(seconds, int) or seconds < 1:
        raise ValueError("the interval must be a positive whole number of seconds")
    return seconds


def _floor_div(value: Column, divisor: int) -> Column:
    # The difference is a multiple of the divisor and far below 2**53: the division is exact.
    return ((value - F.pmod(value, F.lit(divisor))) / F.lit(divisor)).cast("bigint")


def _times(events: DataFrame, column: str, forward: bool) -> DataFrame:
    """`tile` and `u`, integer microseconds; forward windows are backward ones of negated time."""
    ts = F.col(column)
    if isinstance(events.schema[column].dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        u = F.round(ts.cast("double") * 1_000_000).cast("bigint")
    else:
        u = micros(ts)
    times = events.where(ts.isNotNull()).select((-u if forward else u).alias("u"))
    return times.withColumn("tile", _floor_div(F.col("u"), _TILE))


def _tile_windows(per_tile: DataFrame, seconds: int) -> DataFrame:
    """Per tile with events: `base`, events of the `seconds` tiles before it; `lower`, of the last
    `seconds` tiles up to and with it; `upper`, of both.

    The same signed running sum, one level up: groups of `seconds` tiles, so at most twice as many
    rows per group.
    """
    home = F.struct(
        _floor_div(F.col("tile"), seconds).alias("grp"), F.col("tile").alias("pos"), F.col("n").alias("w")
    )
    away = F.struct(
        (_floor_div(F.col("tile"), seconds) + 1).alias("grp"),
        (F.col("tile") + seconds).alias("pos"),
        (-F.col("n")).alias("w"),
    )
    rows = per_tile.select(F.inline(F.array(home, away)))
    group = Window.partitionBy("grp")
    before = group.orderBy("pos").rangeBetween(Window.unboundedPreceding, -1)
    until = group.orderBy("pos").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    opening = F.coalesce(-F.sum(F.when(F.col("w") < 0, F.col("w"))).over(group), F.lit(0))
    known = rows.select(
        "pos",
        "w",
        (opening + F.coalesce(F.sum("w").over(before), F.lit(0))).alias("base"),
        (opening + F.sum("w").over(until)).alias("lower"),
    )
    return known.where(F.col("w") > 0).select(
        F.col("pos").alias("tile"), "base", "lower", (F.col("base") + F.col("w")).alias("upper")
    )


def _exact_counts(distinct_times: DataFrame, bases: DataFrame, seconds: int) -> DataFrame:
    """`(u, n, c)` for the times in tiles of `bases`: how often u occurs, events in [u - S, u]."""
    home = F.struct("tile", F.col("u").alias("pos"), F.lit(0).alias("kind"), F.col("n").alias("w"))
    away = F.struct(
        (F.col("tile") + seconds).alias("tile"),
        (F.col("u") + seconds * _TILE).alias("pos"),
        F.lit(1).alias("kind"),
        (-F.col("n")).alias("w"),
    )
    rows = distinct_times.select(F.inline(F.array(home, away)))
    # An event exactly S earlier is inside: at equal positions it is subtracted after the sum.
    so_far = (
        Window.partitionBy("tile")
        .orderBy("pos", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = rows.withColumn("run", F.sum("w").over(so_far)).where(F.col("kind") == 0)
    return running.join(bases.select("tile", "base"), "tile").select(
        F.col("pos").alias("u"), F.col("w").alias("n"), (F.col("base") + F.col("run")).alias("c")
    )


def _distinct_counts(times: DataFrame) -> DataFrame:
    return times.groupBy("tile", "u").agg(F.count(F.lit(1)).alias("n"))


def _as_input(events: DataFrame, column: str, u: Column) -> Column:
    kind = events.schema[column].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return (u / F.lit(1_000_000.0)).cast(kind)
    return F.timestamp_micros(u).cast(kind)


def _counts(
    events: DataFrame, column: str, seconds: int, forward: bool
) -> DataFrame:
    times = _distinct_counts(_times(events, column, forward))
    per_tile = times.groupBy("tile").agg(F.sum("n").alias("n"))
    return _exact_counts(times, _tile_windows(per_tile, seconds), seconds)


def _one_by_one(counts: DataFrame) -> DataFrame:
    """A row per event again, with `i` from 0 among equal times.

    A time shared by very many events is cut into chunks that different tasks write out.
    """
    chunks = counts.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(_CHUNK))).alias("lo")
    ).repartition("u", "lo")
    last = F.least(F.col("lo") + _CHUNK, F.col("n")) - 1
    return chunks.select("u", "c", F.explode(F.sequence(F.col("lo"), last)).alias("i"))


def burst_counts(
    events: DataFrame, column: str = "ts_event_meta_dt", seconds: int = BURST_SECONDS
) -> DataFrame:
    """For every event the number of events in the `seconds` up to it, both ends included."""
    rows = _one_by_one(_counts(events, column, _checked_seconds(seconds), forward=False))
    return rows.select(_as_input(events, column, F.col("u")).alias("window_end"), "c")


def burst_counts_forward(
    events: DataFrame, column: str = "ts_event_meta_dt", seconds: int = BURST_SECONDS
) -> DataFrame:
    """For every event, in order of time, the number of events from it on within `seconds`.

    Of events at the same time each one has one less than the one before.
    """
    rows = _one_by_one(_counts(events, column, _checked_seconds(seconds), forward=True))
    return rows.select(
        _as_input(events, column, -F.col("u")).alias("window_start"), (F.col("c") - F.col("i")).alias("c")
    )


def _peak(events: DataFrame, column: str, seconds: int, forward: bool) -> DataFrame:
    # Counted once, as by the full analysis; tiles and the close look both use these counts.
    times = _distinct_counts(_times(events, column, forward))
    per_tile = times.groupBy("tile").agg(F.sum("n").alias("n"))
    bounds = _tile_windows(per_tile, seconds)
    # The window of a tile's last event holds at least `lower`, no window of the tile over `upper`.
    reached = bounds.agg(F.max("lower")).scalar()
    candidates = bounds.where(F.col("upper") >= reached)
    needed = candidates.select(F.explode(F.array("tile", F.col("tile") - seconds)).alias("tile"))
    close = times.join(needed, "tile", "left_semi")
    counts = _exact_counts(close, candidates, seconds)
    time = -F.col("u") if forward else F.col("u")
    return counts.select(time.alias("u"), "c").orderBy(F.desc("c"), F.asc("u")).limit(1)


def second_counts(events: DataFrame, column: str = "ts_event_meta_dt") -> DataFrame:
    """Events per second of the epoch: `second`, `n`. Events without a time are left out."""
    seconds = _times(events, column, forward=False).groupBy(F.col("tile").alias("second"))
    return seconds.agg(F.count(F.lit(1)).alias("n"))


def merge_second_counts(*counts: DataFrame) -> DataFrame:
    """One set of counts per second from those of several loads, in any order."""
    rows = functools.reduce(DataFrame.unionByName, counts)
    return rows.groupBy("second").agg(F.sum("n").alias("n"))


def peak_from_seconds(
    counts: DataFrame,
    events: DataFrame,
    column: str = "ts_event_meta_dt",
    seconds: int = BURST_SECONDS,
    forward: bool = False,
    day_column: str | None = None,
) -> DataFrame:
    """As `peak_burst`, or with `forward` as `peak_burst_forward`, by stored counts of the same events.

    Counts may hold a second in several rows. Of `events` only those near seconds that can hold the
    peak are looked at; with `day_column`, the day in the events' own text by which they are
    stored, only those partitions are read: the days, one beside them, as an offset moves a time by less
    than a day, and the partition of texts without a date.
    """
    sign = -1 if forward else 1
    size = _checked_seconds(seconds)

    def turned(value: Column) -> Column:
        # Forward, time is mirrored at half a microsecond, so that whole seconds stay whole.
        return -1 - value if forward else value

    per_tile = counts.groupBy(turned(F.col("second")).alias("tile")).agg(F.sum("n").alias("n"))
    bounds = _tile_windows(per_tile, size)
    reached = bounds.agg(F.max("lower")).scalar()
    candidates = bounds.where(F.col("upper") >= reached).select("tile")
    # Blocks of `seconds` tiles: a window that ends in one begins there or in the one before.
    block = _floor_div(F.col("tile"), size)
    blocks = candidates.select(F.explode(F.array(block, block - 1)).alias("block")).distinct()
    if day_column:
        edge = [F.col("block") * size * sign, ((F.col("block") + 1) * size) * sign]
        first, last = (F.to_date(F.timestamp_seconds(pick(*edge))) for pick in (F.least, F.greatest))
        days = blocks.select(F.explode(F.sequence(F.date_sub(first, 1), F.date_add(last, 1))).alias("day")).distinct()
        wanted = [r["day"] for r in days.collect()]  # one row a day
        events = events.where(F.col(day_column).isin(wanted) | F.col(day_column).isNull())
    times = _times(events, column, forward=False).select(turned(F.col("u")).alias("u"), turned(F.col("tile")).alias("tile"))
    times = times.withColumn("block", _floor_div(F.col("tile"), size))
    near = _distinct_counts(times.join(blocks, "block", "left_semi"))
    exact = _exact_counts(near, bounds.join(candidates, "tile", "left_semi"), size)
    peak = exact.select(turned(F.col("u")).alias("u"), "c").orderBy(F.desc("c"), F.asc("u")).limit(1)
    names = ("t0", "len") if forward else ("window_end", "c")
    return peak.select(_as_input(events, column, F.col("u")).alias(names[0]), F.col("c").alias(names[1]))


def peak_burst(
    events: DataFrame, column: str = "ts_event_meta_dt", seconds: int = BURST_SECONDS
) -> DataFrame:
    """The end of the densest interval and its count; the earliest of several."""
    peak = _peak(events, column, _checked_seconds(seconds), forward=False)
    return peak.select(_as_input(events, column, F.col("u")).alias("window_end"), "c")


def peak_burst_forward(
    events: DataFrame, column: str = "ts_event_meta_dt", seconds: int = BURST_SECONDS
) -> DataFrame:
    """The start of the densest interval and its count; the earliest of several, none of no events."""
    peak = _peak(events, column, _checked_seconds(seconds), forward=True)
    return peak.select(_as_input(events, column, F.col("u")).alias("t0"), F.col("c").alias("len"))
