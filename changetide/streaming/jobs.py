"""The continuous forms of loading, counting, de-duplication and watching."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from changetide.operators.filters import TS, drop_canary, watch_user
from changetide.operators.registry import load_fact, record_facts, timestamp_fact
from changetide.operators.staging import add_content_key, parse_changes
from changetide.operators.status import health_status
from changetide.operators.rollups import refresh_rollups
from changetide.plans.load import merge_staged, now, stage_lines, staged_days
from changetide.schema import CANARY_DOMAIN, DUMP_GLOB, EVENT_COLUMNS, HEALTH_MAX_AGE_SECONDS
from changetide.session import drop_scratch, require_utc, scratch_dir
from changetide.sources.dumps import stream_dumps
from changetide.sources.tables import ensure_registry, ensure_table


def stream_load(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    registry: str | None = None,
    rollups: str | None = None,
    glob: str = DUMP_GLOB,
    max_files: int | None = None,
) -> StreamingQuery:
    """Load dumps as they turn up; takes all that are there and stops, to be started hourly.

    The checkpoint remembers the files done; registry and rollups are kept as by `load_batch`, dumps without
    lines included. A batch that is run again after a crash has the same load id, as the id of the
    query lives in its checkpoint; it finds its own rows in the table and adds the missing ones only.
    """
    require_utc(spark)
    ensure_table(spark, target)
    if registry:
        ensure_registry(spark, registry)

    def load(lines: DataFrame, batch_id: int) -> None:
        session, begin = lines.sparkSession, now()
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = scratch_dir(session, "staged")
        try:
            staged = stage_lines(lines, folder)
            if registry:
                names = staged.select("filename").distinct()
                record_facts(timestamp_fact(names, "load_begin", begin), registry)
            counts = merge_staged(staged, target, f"stream:{query_id}:{batch_id}")
            if registry:
                record_facts(load_fact(counts, now()), registry)
            if rollups:
                refresh_rollups(session, target, rollups, staged_days(staged))
        finally:
            drop_scratch(session, folder)

    return (
        stream_dumps(spark, folder, glob, max_files, marks=True)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def keyed_events(lines: DataFrame) -> DataFrame:
    """Lines to events with key and time, without test events and events of unknown domain."""
    return real_events(add_content_key(parse_changes(lines))).select(*EVENT_COLUMNS)


def real_events(events: DataFrame) -> DataFrame:
    """Events that the table would take: no test events, none of unknown domain."""
    return events.where(F.col("event_meta_domain") != CANARY_DOMAIN)


def stream_dedup(events: DataFrame, delay: str = "1 hour", salts: int = 8) -> DataFrame:
    """Drop repetitions that come within `delay`; the state is bounded by it.

    Events later than `delay` are dropped too, repeated or not; `late_rows` tells how many, and the
    table, kept free of repetitions by the merge, has them. A stream drops repetitions only after
    its shuffle, so the copies of a key are first spread over `salts` keys; at most that many rows
    of it meet in the second step. The seed makes the spreading the same when a task is run again.
    `salts=1` leaves the first step out.
    """
    watched = events.withWatermark(TS, delay)
    if salts > 1:
        salted = watched.withColumn("_salt", F.floor(F.rand(0) * salts))
        watched = salted.dropDuplicatesWithinWatermark(["_h", "_salt"]).drop("_salt")
    return watched.dropDuplicatesWithinWatermark(["_h"])


def late_rows(query: StreamingQuery) -> int:
    """How many rows the query has dropped as later than its delay, in the progress it remembers."""
    return sum(
        state.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def stream_hourly_counts(
    events: DataFrame, delay: str = "1 hour", edits_only: bool = False
) -> DataFrame:
    """Hourly counts per wiki as the table would have them, each hour written once when it is closed.

    Test events and repetitions are left out. An hour is closed when the newest event is `delay` past its
    end; the open hours are never shown. Events later than `delay` are missing here (`late_rows`);
    the refresh of the stored rollups includes them.
    """
    clean = stream_dedup(real_events(events), delay)
    if edits_only:
        clean = clean.where(F.col("event_type") == "edit")
    counts = (
        clean.groupBy(F.window(TS, "1 hour").alias("span"), "event_wiki")
        .agg(
            F.count(F.lit(1)).alias("count_bot_flagignore"),
            F.count_if("event_bot").alias("count_bot_true"),
            F.count_if(~F.col("event_bot")).alias("count_bot_false"),
        )
    )
    return counts.select(
        F.to_date("span.start").alias("date"),
        F.hour("span.start").alias("hour"),
        "event_wiki",
        "count_bot_flagignore",
        "count_bot_true",
        "count_bot_false",
    )


def stream_health(
    events: DataFrame, as_of: dt.datetime | str, max_age: float = HEALTH_MAX_AGE_SECONDS
) -> DataFrame:
    """Status from the newest event so far (output mode complete; one row of state)."""
    return health_status(events, as_of, max_age)


def query_health(
    query: StreamingQuery, as_of: dt.datetime, max_age: float = HEALTH_MAX_AGE_SECONDS
) -> str:
    """OK or ERROR from the newest event time a running query with a watermark reports."""
    seen = [p["eventTime"]["max"] for p in query.recentProgress if "max" in (p["eventTime"] or {})]
    if not seen:
        return "ERROR"
    newest = dt.datetime.fromisoformat(max(seen).replace("Z", "+00:00"))
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=dt.timezone.utc)
    return "OK" if (as_of - newest).total_seconds() <= max_age else "ERROR"


def stream_watch_user(events: DataFrame, user: str) -> DataFrame:
    """Events of one user without test events, to be written to a sink of their own."""
    return watch_user(drop_canary(events), user)


def run_to_folder(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Write what is available of a stream to Parquet files, wait for the end, and return the query."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
