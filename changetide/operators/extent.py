"""Oldest and newest event of a stored table, looked for in its outermost days only.

Days are those of the event text, so an event lies up to 18 hours (the largest offset of a time zone) outside its
day. Of the outermost day with a time at all, and the two days inside of it, one has the extreme. The
days come from the names of the partitions, one a day; no file of the others is opened.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from changetide.functions.columns import hour_start
from changetide.operators.filters import TS
from changetide.sources import files
from changetide.sources.tables import read_changes

#: Days inside of the outermost one that may have an event beyond its events.
BESIDE = 2


def stored_days(spark: SparkSession, path: str) -> list[dt.date]:
    """Days that the table has a partition of, in order; text that is no date has no day, and no time."""
    names = (f.rsplit("event_date=", 1)[1] for f in files.children(spark, path) if "/event_date=" in f)
    return sorted(dt.date.fromisoformat(n) for n in names if n[:1].isdigit())


def outermost(spark: SparkSession, path: str, newest: bool) -> dt.datetime | None:
    """Time of the newest or oldest event. A day without any time, as of odd texts, costs another look."""
    pick = F.max if newest else F.min
    days = sorted(stored_days(spark, path), reverse=newest)
    changes = read_changes(spark, path)
    while days:
        near = [d for d in days if abs((d - days[0]).days) <= BESIDE]
        found = changes.where(F.col("event_date").isin(near)).groupBy("event_date").agg(pick(TS).alias("t")).where("t IS NOT NULL")
        times = {r["event_date"]: r["t"] for r in found.collect()}  # three days at most
        if days[0] in times:
            return (max if newest else min)(times.values())
        # The next look begins with the outermost day that has a time, or behind the days looked at.
        days = [d for d in days if d in times or d not in near] if times else [d for d in days if d not in near]
    return None


def stored_extent(spark: SparkSession, path: str) -> DataFrame:
    """One row: min_ts, max_ts."""
    ends = (outermost(spark, path, False), outermost(spark, path, True))
    return spark.createDataFrame([ends], "min_ts timestamp, max_ts timestamp")


def stored_complete_hours(spark: SparkSession, path: str) -> DataFrame:
    """Events of a stored table without the last hour, which is still being filled; the limit is a constant of the scan."""
    newest = F.lit(outermost(spark, path, True)).cast("timestamp")
    return read_changes(spark, path).where(F.col(TS) < hour_start(newest))
