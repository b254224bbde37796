"""File registry: an append-only log of facts and the current state per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from changetide.schema import REGISTRY_SCHEMA
from changetide.sources import files

# Kinds of facts. The three time stamps a load reports, and two more.
TIMESTAMP_FACTS = ["load_begin", "load_complete", "archived"]
FACTS = ["registered", "transferred", *TIMESTAMP_FACTS]


def timestamp_fact(files: DataFrame, kind: str, at: object) -> DataFrame:
    """Facts saying that `kind` happened to the files (column `filename`) at time `at`."""
    if kind not in FACTS:
        raise ValueError(f"unknown kind of time stamp: {kind}")
    facts = files.select(
        "filename",
        F.lit(kind).alias("fact"),
        F.lit(at).cast("timestamp").alias("at"),
        F.lit(None).cast("bigint").alias("events_in_file"),
        F.lit(None).cast("bigint").alias("events_merged"),
    )
    return facts.select(*REGISTRY_SCHEMA.fieldNames())


def load_fact(stats: DataFrame, at: object) -> DataFrame:
    """Completion facts with the event counts of a load (`filename`, `lines`, `merged`)."""
    return stats.select(
        "filename",
        F.lit("load_complete").alias("fact"),
        F.lit(at).cast("timestamp").alias("at"),
        F.col("lines").cast("bigint").alias("events_in_file"),
        F.col("merged").cast("bigint").alias("events_merged"),
    )


def record_facts(facts: DataFrame, path: str) -> None:
    """Append facts; one per file of a load, gathered into files of a suitable size."""
    facts.hint("rebalance").write.mode("append").parquet(path)


def registry_state(facts: DataFrame) -> DataFrame:
    """One row per file: the latest time of each kind and the latest event counts."""

    def latest(kind: str):
        return F.max(F.when(F.col("fact") == kind, F.col("at")))

    counted = F.when(F.col("events_in_file").isNotNull(), F.col("at"))
    return facts.groupBy("filename").agg(
        F.min(F.when(F.col("fact") == "registered", F.col("at"))).alias("ts_entry_creation"),
        latest("transferred").alias("ts_file_transfer"),
        latest("load_begin").alias("ts_load_begin"),
        latest("load_complete").alias("ts_load_end"),
        F.max_by("events_in_file", counted).alias("loadstat_events_in_file"),
        F.max_by("events_merged", counted).alias("loadstat_events_merged"),
        latest("archived").alias("ts_file_archive"),
    )


def compact_facts(facts: DataFrame) -> DataFrame:
    """Facts that say the same of each file in few rows: one per kind, and the one with the latest counts.

    `registry_state` takes first and last times and the latest counts, so facts may be gathered in any order, again
    and again, and beside those they were made from.
    """
    at = F.when(F.col("fact") == "registered", F.min("at")).otherwise(F.max("at"))
    times = facts.groupBy("filename", "fact").agg(at.alias("at"))
    counted = facts.where(F.col("events_in_file").isNotNull()).groupBy("filename").agg(
        F.max(F.struct("at", "events_in_file", "events_merged", "fact")).alias("last")
    )
    nothing = F.lit(None).cast("bigint")
    both = times.withColumns({"events_in_file": nothing, "events_merged": nothing}).unionByName(
        counted.select("filename", "last.fact", "last.at", "last.events_in_file", "last.events_merged")
    )
    return both.select(*REGISTRY_SCHEMA.fieldNames())


def compact_registry(spark: SparkSession, path: str) -> None:
    """Replace the log by its compact form: that is added first, then the old files go.

    A reader, or a run that dies in between, finds facts twice, which changes nothing. Facts that are
    recorded meanwhile stay, as only files that were read are removed.
    """
    old = [f for f in files.children(spark, path) if f.endswith(".parquet")]
    if old:
        record_facts(compact_facts(spark.read.schema(REGISTRY_SCHEMA).parquet(*old)), path)
        for file in old:
            files.drop(spark, file)
