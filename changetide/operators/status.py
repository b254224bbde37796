"""Age, size and health of the event table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from changetide.functions.columns import at, seconds_between
from changetide.operators.filters import TS
from changetide.schema import HEALTH_MAX_AGE_SECONDS


def oldest_event(changes: DataFrame) -> DataFrame:
    return changes.agg(F.min(TS).alias("min_ts"))


def newest_event(changes: DataFrame, zone: str | None = None) -> DataFrame:
    """Newest event time; with a time zone also as ISO text in local time."""
    newest = changes.agg(F.max(TS).alias("max_ts"))
    if zone is None:
        return newest
    utc = F.col("max_ts").cast("timestamp")
    local = F.from_utc_timestamp(utc, zone)
    minutes = ((F.unix_micros(local) - F.unix_micros(utc)) / F.lit(60_000_000)).cast("int")
    sign = F.when(minutes < 0, "-").otherwise("+")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    hours = (F.abs(minutes) / F.lit(60)).cast("int")
    offset = F.concat(sign, two(hours), F.lit(":"), two(F.abs(minutes) % 60))
    whole = F.date_trunc("SECOND", local) == local
    text = F.when(whole, F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    text = F.concat(text, offset)
    return newest.withColumn("max_ts_local", text)


def _age(as_of: dt.datetime | str) -> Column:
    return seconds_between(F.max(TS), at(as_of))


def freshness_age(changes: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Seconds from the newest event to `as_of`."""
    return changes.agg(_age(as_of).alias("freshness_sec"))


def event_count(changes: DataFrame) -> DataFrame:
    return changes.agg(F.count(F.lit(1)).alias("nevents"))


def db_stats(changes: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Oldest and newest event, age and number of events, in one pass."""
    return changes.agg(
        F.min(TS).alias("min_ts"),
        F.max(TS).alias("max_ts"),
        _age(as_of).alias("freshness_sec"),
        F.count(F.lit(1)).alias("nevents"),
    )


def duplicate_meta_ids(changes: DataFrame) -> DataFrame:
    """Event ids that occur more than once; missing ids are one group."""
    counts = changes.groupBy("event_meta_id").agg(F.count(F.lit(1)).alias("c"))
    return counts.where(F.col("c") >= 2)


def health_status(
    heartbeats: DataFrame, as_of: dt.datetime | str, max_age: float = HEALTH_MAX_AGE_SECONDS
) -> DataFrame:
    """OK if there is an event not older than `max_age` seconds, otherwise ERROR.

    The newest event counts in whatever order they came in. Batch, or streaming in complete mode.
    """
    newest = heartbeats.agg(F.max(TS).alias("last_event"))
    age = seconds_between(F.col("last_event"), at(as_of))
    ok = F.coalesce(age <= F.lit(float(max_age)), F.lit(False))
    return newest.select(
        "last_event",
        age.alias("age_sec"),
        F.when(ok, F.lit("OK")).otherwise(F.lit("ERROR")).alias("status"),
    )
