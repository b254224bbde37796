"""Loading dumps into the event table: parse once, then de-duplicate, merge and count."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changetide.functions.columns import base_name
from changetide.operators.filters import TS
from changetide.operators.registry import load_fact, record_facts, timestamp_fact
from changetide.operators.rollups import both_hourly_counts, refresh_rollups
from changetide.operators.staging import (
    add_content_key,
    batch_ranges,
    dedup_changes,
    inspect_lines,
    merge_changes,
    possible_matches,
)
from changetide.schema import CANARY_DOMAIN, DUMP_GLOB, EVENT_COLUMNS
from changetide.session import drop_scratch, require_utc, scratch_dir
from changetide.sources.commits import attempt_of, commit, new_attempt, read_commits, store_counts
from changetide.sources.dumps import list_dumps, read_lines
from changetide.sources.tables import committed_table, ensure_registry, ensure_table, read_table, with_partitions


STATS_SCHEMA = (
    "filename string, lines bigint, undecodable bigint, staged bigint, ill_typed bigint, "
    "deduplicated bigint, merged bigint"
)


def file_name() -> Column:
    """Name a line is accounted under: its dump, or the folder of a dump written in several files."""
    folder = F.regexp_extract("path", r"/dump=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(base_name(F.col("path")))


def stage_lines(lines: DataFrame, folder: str) -> DataFrame:
    """Write every line, parsed, to a staging table and read it back.

    Dumps are unpacked and parsed once; counting, ranges and de-duplication then read only the
    columns they need, and a lost executor costs no second parse.
    """
    rows = with_partitions(add_content_key(inspect_lines(lines))).select(
        file_name().alias("filename"),
        "decodable",
        "has_meta",
        F.col("corrupt_text").isNotNull().alias("ill_typed"),
        F.col("value").isNotNull().alias("is_line"),
        *EVENT_COLUMNS,
        "event_date",
    )
    rows.write.parquet(folder)
    return lines.sparkSession.read.schema(rows.schema).parquet(folder)


def merge_staged(staged: DataFrame, target: str, load_id: str) -> DataFrame:
    """Merge a staging table into the event table as one load; returns the counts per file.

    A key found in several files is credited to the first by name that has it as a real event, as if
    they were loaded in turn. `deduplicated` are a file's keys with a real event, which are those that
    de-duplication leaves of the file alone.
    Events and their hourly counts are written under the id of this attempt and count once it is committed.
    A load that was committed under its id is not run again; one that died before starts anew, beside
    what it left. What was merged is counted in the table itself.
    """
    spark = staged.sparkSession
    events = staged.where("has_meta")
    ranges = batch_ranges(events).collect()
    attempt = attempt_of(spark, target, load_id)
    if attempt is None:
        attempt = new_attempt()
        batch = dedup_changes(events.select("filename", *EVENT_COLUMNS), first=("filename",))
        batch = batch.withColumns({"load_id": F.lit(attempt), "load_file": F.col("filename")})
        merge_changes(batch, target, ranges, committed_table(spark, target))
        new = possible_matches(read_table(spark, target), ranges).where(F.col("load_id") == attempt)
        if read_commits(spark, target) is not None:
            store_counts(spark, both_hourly_counts(new.where(F.col(TS).isNotNull())), target, attempt)
            commit(spark, target, load_id, attempt)

    distinct_key = F.when(F.col("has_meta") & (F.col("event_meta_domain") != CANARY_DOMAIN), F.col("_h"))
    counts = staged.groupBy("filename").agg(
        F.count_if("is_line").alias("lines"),
        F.count_if(F.col("is_line") & ~F.col("decodable")).alias("undecodable"),
        F.count_if("has_meta").alias("staged"),
        F.count_if("ill_typed").alias("ill_typed"),
        F.count_distinct(distinct_key).alias("deduplicated"),
    )
    merged = (
        possible_matches(read_table(spark, target), ranges)
        .where(F.col("load_id") == attempt)
        .groupBy(F.col("load_file").alias("filename"))
        .agg(F.count(F.lit(1)).alias("merged"))
    )
    return counts.join(merged, "filename", "left").fillna(0, ["merged"])


def staged_days(staged: DataFrame) -> list[dt.date]:
    """UTC days of the events of a staging table, for the refresh of the rollups."""
    day = F.to_date("ts_event_meta_dt").alias("day")
    rows = staged.where(F.col("ts_event_meta_dt").isNotNull()).select(day).distinct().collect()
    return sorted(r["day"] for r in rows)


def checked_files(files: list[str] | str) -> list[str]:
    """A list of names; one name counts as a list of one. ValueError for anything else."""
    if isinstance(files, str):
        files = [files]
    if not (isinstance(files, list) and all(isinstance(f, str) for f in files)):
        raise ValueError(f"expected a list of file names, got {type(files).__name__}")
    return files


def load_batch(
    spark: SparkSession,
    files: list[str] | str,
    target: str,
    registry: str | None = None,
    rollups: str | None = None,
    load_id: str | None = None,
    glob: str | None = DUMP_GLOB,
) -> DataFrame:
    """Load dumps (or folders of them) as one batch with one write to the table.

    Readers of the table, and of the counts kept with it (`committed_rollup`), see all of the load or nothing of it.
    Returns per file: lines, undecodable lines, staged and ill-typed events, events after
    de-duplication, merged events. Loading a file again merges nothing. With `registry` the begin,
    the end and the counts are recorded there; with `rollups` the stored rollups are brought up to
    date afterwards, in a step of its own.
    """
    require_utc(spark)
    files = checked_files(files)
    load_id = load_id or uuid.uuid4().hex
    ensure_table(spark, target)
    if not files:
        return spark.createDataFrame([], STATS_SCHEMA)
    names = list_dumps(spark, files, glob).select(file_name().alias("filename")).distinct()
    if registry:
        ensure_registry(spark, registry)
        record_facts(timestamp_fact(names, "load_begin", now()), registry)
    folder = scratch_dir(spark, "staged")
    try:
        staged = stage_lines(read_lines(spark, files, glob), folder)
        counts = names.join(merge_staged(staged, target, load_id), "filename", "left").fillna(0)
        # Stored, as they are counted in the staging table.
        stats_folder = scratch_dir(spark, "load-stats")
        counts.write.parquet(stats_folder)
        stats = spark.read.schema(counts.schema).parquet(stats_folder)
        if registry:
            record_facts(load_fact(stats, now()), registry)
        if rollups:
            refresh_rollups(spark, target, rollups, staged_days(staged))
    finally:
        drop_scratch(spark, folder)
    return stats


def dump_quality(lines: DataFrame) -> DataFrame:
    """Per dump: lines, and how many of them are not JSON."""
    return (
        inspect_lines(lines)
        .groupBy(file_name().alias("filename"))
        .agg(F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("decodable")).alias("undecodable"))
    )


def first_event_time(lines: DataFrame) -> DataFrame:
    """Per dump the time of its first event, the logical date of its load; dumps by name."""
    keyed = add_content_key(inspect_lines(lines).where("has_meta"))
    # Per file (or block of one) first: numbers only, so the partial aggregation is a hash table.
    per_block = keyed.groupBy("path", F.col("line_pos.block").alias("block")).agg(
        F.min_by("ts_event_meta_dt", F.col("line_pos.seq")).alias("first_ts")
    )
    return (
        per_block.groupBy(file_name().alias("filename"))
        .agg(F.min_by("first_ts", F.struct("path", "block")).alias("first_ts"))
        .orderBy("filename")
    )


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)
