"""Event times as CSV of epoch seconds, one value per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from changetide.functions.columns import epoch_seconds


def export_epochs(changes: DataFrame, folder: str) -> None:
    """Epoch seconds of all events, no header, any order; events without a time are left out."""
    times = changes.where(F.col("ts_event_meta_dt").isNotNull())
    times.select(epoch_seconds(F.col("ts_event_meta_dt")).alias("e")).write.csv(folder)


def read_epochs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Values `d` of such files; empty lines are skipped."""
    return spark.read.schema("d DOUBLE").csv(paths)
