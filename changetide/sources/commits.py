"""Loads that readers see whole or not at all.

Every attempt of a load writes its events, and the counts of these, under an id of its own; they count from the
moment the attempt's row is in the commit table, which is the last thing written. Readers meet events and
counts with that table, so both appear together. An attempt that died is never seen; its keys are free
for the next one. The commit table has a row a load; it lies in the folder of the event table, under a
name that scans of the table pass over.

Counts per hour and wiki are distributive: each load stores those of its new events only, whatever days they are
of, and readers add them up. Folding replaces many of these by one, again by a commit.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from changetide.functions.columns import hour_timestamp
from changetide.schema import ROLLUP_SCHEMA
from changetide.sources import files

COMMIT_SCHEMA = "load_id string, attempt string, committed_at timestamp, folded array<string>"
_COUNTS = ["count_bot_flagignore", "count_bot_true", "count_bot_false"]
_KEYS = ["date", "hour", "event_wiki", "rollup"]
COUNTS_SCHEMA = (
    "date date, hour int, event_wiki string, rollup string, count_bot_flagignore bigint, "
    "count_bot_true bigint, count_bot_false bigint, attempt string"
)
#: Load id of commits that only fold counts.
FOLD = "fold"


def _commits(target: str) -> str:
    return f"{target.rstrip('/')}/_commits"


def _counts(target: str) -> str:
    return f"{target.rstrip('/')}/_counts"


def ensure_commits(spark: SparkSession, target: str) -> None:
    if not files.exists(spark, _commits(target)):
        spark.createDataFrame([], COUNTS_SCHEMA).write.mode("ignore").partitionBy("attempt").parquet(_counts(target))
        spark.createDataFrame([], COMMIT_SCHEMA).write.mode("ignore").parquet(_commits(target))


def read_commits(spark: SparkSession, target: str) -> DataFrame | None:
    """The commit table, or None for a table without loads, of which all rows count."""
    if not files.exists(spark, _commits(target)):
        return None
    return spark.read.schema(COMMIT_SCHEMA).parquet(_commits(target))


def only_committed(rows: DataFrame, commits: DataFrame | None) -> DataFrame:
    """Rows of committed loads, and rows that no load wrote. One small join, broadcast as long as it is small."""
    if commits is None:
        return rows
    no_load = commits.sparkSession.range(1).select(F.lit(None).cast("string").alias("attempt"))
    seen = commits.select("attempt").union(no_load).distinct()
    return rows.join(seen, rows["load_id"].eqNullSafe(seen["attempt"]), "left_semi")


def attempt_of(spark: SparkSession, target: str, load_id: str) -> str | None:
    """The attempt by which a load was committed, if it was."""
    commits = read_commits(spark, target)
    row = commits.where(F.col("load_id") == load_id).select(F.min("attempt").alias("a")).first() if commits is not None else None
    return row["a"] if row else None


def new_attempt() -> str:
    return uuid.uuid4().hex


def commit(spark: SparkSession, target: str, load_id: str, attempt: str, folded: list[str] | None = None) -> None:
    """Make an attempt count, in the place of those it folds: one row in one file, so it is there or not."""
    row = (load_id, attempt, dt.datetime.now(dt.timezone.utc), folded or [])
    spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(_commits(target))


def compact_commits(spark: SparkSession, target: str) -> None:
    """Gather the commit table in one file. Readers do not mind rows that are there twice for a moment."""
    old = [f for f in files.children(spark, _commits(target)) if f.endswith(".parquet")]
    if len(old) > 1:
        rows = spark.read.schema(COMMIT_SCHEMA).parquet(*old).distinct()
        rows.coalesce(1).write.mode("append").parquet(_commits(target))
        for file in old:
            files.drop(spark, file)


def store_counts(spark: SparkSession, counts: DataFrame, target: str, attempt: str) -> None:
    """Counts of an attempt: date, hour, event_wiki, rollup and the three counts."""
    named = counts.select(*_KEYS, *_COUNTS, F.lit(attempt).alias("attempt"))
    named.coalesce(1).write.mode("append").partitionBy("attempt").parquet(_counts(target))


def _live(spark: SparkSession, target: str) -> DataFrame:
    """Attempts whose counts are to be added: committed and not folded into another."""
    commits = spark.read.schema(COMMIT_SCHEMA).parquet(_commits(target))
    folded = commits.select(F.explode("folded").alias("attempt"))
    return commits.select("attempt").distinct().join(folded, "attempt", "left_anti")


def added_counts(spark: SparkSession, target: str) -> DataFrame:
    """Counts of all committed loads, the last hour included: date, hour, event_wiki, rollup, three counts."""
    stored = spark.read.schema(COUNTS_SCHEMA).parquet(_counts(target))
    live = stored.join(_live(spark, target), "attempt", "left_semi")
    return live.groupBy(*_KEYS).agg(*(F.sum(c).alias(c) for c in _COUNTS))


def committed_rollups(spark: SparkSession, target: str) -> DataFrame:
    """Both rollups as a full refresh would give them at this moment: complete hours only."""
    counts = added_counts(spark, target)
    start = hour_timestamp(F.col("date"), F.col("hour"))
    last = added_counts(spark, target).where("rollup = 'all'").agg(F.max(start).alias("cut")).scalar()
    return counts.where(start < last).select(*ROLLUP_SCHEMA.fieldNames())


def committed_rollup(spark: SparkSession, target: str, edits_only: bool = False) -> DataFrame:
    kind = "edits" if edits_only else "all"
    return committed_rollups(spark, target).where(F.col("rollup") == kind).drop("rollup")


def fold_counts(spark: SparkSession, target: str, counts: DataFrame | None = None) -> None:
    """Store the counts of all committed loads as one; `counts`, if given, takes their place (say, a full recount).

    Readers see the old or the new counts. What earlier folds replaced is removed, so a reader has until the
    next fold to finish. One load or fold of a table at a time.
    """
    gone = [r["a"] for r in read_commits(spark, target).select(F.explode("folded").alias("a")).distinct().toLocalIterator()]
    attempts = [r["attempt"] for r in _live(spark, target).toLocalIterator()]
    attempt = new_attempt()
    store_counts(spark, added_counts(spark, target) if counts is None else counts, target, attempt)
    commit(spark, target, FOLD, attempt, attempts)
    for old in gone:
        files.drop(spark, f"{_counts(target)}/attempt={old}")
