"""The event table, the rollups and the file registry as Parquet datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from changetide.functions.columns import key_date, wiki_group
from changetide.sources.commits import ensure_commits, only_committed, read_commits
from changetide.sources.files import exists
from changetide.schema import (
    EVENT_COLUMNS,
    PARTITION_COLUMNS,
    REGISTRY_SCHEMA,
    ROLLUP_SCHEMA,
    TABLE_SCHEMA,
)


def ensure_table(spark: SparkSession, path: str) -> None:
    """Create the event table, and its commit table, if nothing is stored there yet.

    A table that has rows of loads from before there were commits is left as it is first: all its rows count.
    """
    if not exists(spark, path):
        empty = spark.createDataFrame([], TABLE_SCHEMA)
        empty.write.mode("ignore").partitionBy(*PARTITION_COLUMNS).parquet(path)
        ensure_commits(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All stored rows and columns, those of loads under way too. The schema is given, so no file is opened to plan a query."""
    return spark.read.schema(TABLE_SCHEMA).parquet(path)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The event columns and the partition columns (which the filters use for pruning), of committed loads."""
    return committed_table(spark, path).select(*EVENT_COLUMNS, *PARTITION_COLUMNS)


def committed_table(spark: SparkSession, path: str) -> DataFrame:
    """All columns of the rows that count: those of committed loads, and those written without a load."""
    return only_committed(read_table(spark, path), read_commits(spark, path))


def with_partitions(changes: DataFrame) -> DataFrame:
    return changes.withColumns(
        {
            "event_date": key_date(F.col("event_meta_dt")),
            "wiki_group": wiki_group(F.col("event_wiki")),
        }
    )


def append_changes(changes: DataFrame, path: str) -> None:
    """Append events to the table, split by day and wiki group.

    The rebalance hint lets AQE cut a (day, group) that holds most of the batch into several files
    and join small ones; sorting by the event text gives row groups narrow ranges, which is what
    the merge and the time filters prune by.
    """
    stored = with_partitions(changes)
    for column in ("load_id", "load_file"):
        if column not in stored.columns:
            stored = stored.withColumn(column, F.lit(None).cast("string"))
    (
        stored.select(*TABLE_SCHEMA.fieldNames())
        .hint("rebalance", *PARTITION_COLUMNS)
        .sortWithinPartitions(*PARTITION_COLUMNS, "event_meta_dt")
        .write.mode("append")
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(path)
    )


def read_rollups(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROLLUP_SCHEMA).parquet(path)


def read_rollup(spark: SparkSession, path: str, edits_only: bool = False) -> DataFrame:
    """One of the two stored rollups (`rollup` is a partition column)."""
    kind = "edits" if edits_only else "all"
    return read_rollups(spark, path).where(F.col("rollup") == kind).drop("rollup")


def ensure_registry(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], REGISTRY_SCHEMA).write.mode("ignore").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).parquet(path)
