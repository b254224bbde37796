"""Hourly counts per wiki, and keeping them stored."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changetide.functions.columns import hour_start
from changetide.operators.filters import TS, complete_hours_only, edits_only as only_edits
from changetide.schema import ROLLUP_SCHEMA
from changetide.sources.tables import read_changes, read_rollups

_COUNTS = ["count_bot_flagignore", "count_bot_true", "count_bot_false"]


def _date_and_hour(by_hour: DataFrame, *columns: str) -> DataFrame:
    return by_hour.select(F.to_date("_hour").alias("date"), F.hour("_hour").alias("hour"), *columns)


def date_hour_keys(changes: DataFrame) -> DataFrame:
    return changes.withColumns({"date": F.to_date(TS), "hour": F.hour(TS)})


def hourly_counts(
    changes: DataFrame, edits_only: bool = False, whole: DataFrame | None = None
) -> DataFrame:
    """Per date, hour and wiki: events, those of bots and those not of bots, complete hours only.

    An event without bot flag counts in the first column only; events without wiki are a group.
    Also for the edits the last hour is that of all events (`whole`, default `changes`).
    """
    kept = complete_hours_only(changes, whole)
    if edits_only:
        kept = only_edits(kept)
    by_hour = kept.groupBy(hour_start(F.col(TS)).alias("_hour"), "event_wiki").agg(
        F.count(F.lit(1)).alias("count_bot_flagignore"),
        F.count_if("event_bot").alias("count_bot_true"),
        F.count_if(~F.col("event_bot")).alias("count_bot_false"),
    )
    return _date_and_hour(by_hour, "event_wiki", *_COUNTS)


def both_hourly_counts(kept: DataFrame) -> DataFrame:
    """The rollups of all events and of edits out of one pass; column `rollup` tells them apart."""
    edit = F.col("event_type") == "edit"
    by_hour = kept.groupBy(hour_start(F.col(TS)).alias("_hour"), "event_wiki").agg(
        F.count(F.lit(1)).alias("all_n"),
        F.count_if("event_bot").alias("all_bot"),
        F.count_if(~F.col("event_bot")).alias("all_human"),
        F.count_if(edit).alias("edit_n"),
        F.count_if(edit & F.col("event_bot")).alias("edit_bot"),
        F.count_if(edit & ~F.col("event_bot")).alias("edit_human"),
    )

    def counts(kind: str, prefix: str) -> Column:
        return F.struct(
            F.lit(kind).alias("rollup"),
            F.col(f"{prefix}_n").alias("count_bot_flagignore"),
            F.col(f"{prefix}_bot").alias("count_bot_true"),
            F.col(f"{prefix}_human").alias("count_bot_false"),
        )

    rows = by_hour.select(
        "_hour", "event_wiki", F.inline(F.array(counts("all", "all"), counts("edits", "edit")))
    ).where(F.col("count_bot_flagignore") > 0)
    return _date_and_hour(rows, "event_wiki", *_COUNTS, "rollup")


def refresh_rollups(
    spark: SparkSession, table_path: str, out: str, dates: list[dt.date] | None = None
) -> None:
    """Recompute the stored rollups; with `dates` (UTC days of newly merged events) only in part.

    The partial refresh recomputes those days and all from the last stored day on: the hour that
    was cut off last time lies there, and so does the newest event, so that neither the events nor
    the search for the newest one touch older partitions. Counts never shrink, hence replacing the
    recomputed days is enough.
    """
    changes = read_changes(spark, table_path)
    last = None
    if dates is not None:
        spark.createDataFrame([], ROLLUP_SCHEMA).write.mode("ignore").partitionBy(
            "rollup", "date"
        ).parquet(out)
        last = read_rollups(spark, out).agg(F.max("date").alias("d")).first()["d"]
    if last is None:
        rows = both_hourly_counts(complete_hours_only(changes))
        mode = "static"
    else:
        touched = sorted({d for d in dates if d < last})
        near = sorted({d + dt.timedelta(days=i) for d in touched for i in (-1, 0, 1)})
        recent = F.col("event_date") >= F.lit(last - dt.timedelta(days=1))
        day = F.to_date(TS)
        source = changes.where(recent | F.col("event_date").isin(near)) if near else changes.where(recent)
        again = source.where((day >= F.lit(last)) | day.isin(touched)) if near else source.where(
            day >= F.lit(last)
        )
        rows = both_hourly_counts(complete_hours_only(again, changes.where(recent)))
        mode = "dynamic"
    (
        rows.hint("rebalance", "rollup", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy("rollup", "date")
        .parquet(out)
    )


def rollup_consistency(changes: DataFrame, rollup: DataFrame) -> DataFrame:
    """One row: total of the rollup, events in complete hours, and whether they agree."""
    total = rollup.agg(F.coalesce(F.sum("count_bot_flagignore"), F.lit(0)).alias("rollup_total"))
    raw = complete_hours_only(changes).agg(F.count(F.lit(1)).alias("raw_total"))
    both = total.crossJoin(raw)
    return both.withColumn("ok", F.col("rollup_total") == F.col("raw_total"))
