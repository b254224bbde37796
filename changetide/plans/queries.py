"""Registered queries: every operator over the whole given `events` table."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from changetide import mapping
from changetide.functions.columns import (
    bot_flags,
    event_time,
    hour_timestamp,
    hours_before,
    series_label,
)
from changetide.operators import (
    breakdown,
    bursts,
    extent,
    filters,
    registry,
    retention,
    rollups,
    slices,
    staging,
    status,
    trends,
)
from changetide.plans import load
from changetide.schema import EVENT_COLUMNS, REGISTRY_SCHEMA, STAGED_COLUMNS
from changetide.session import scratch_dir
from changetide.sources import commits, dumps, epochs, files, tables
from changetide.streaming import batches, health, jobs

Query = Callable[[SparkSession, str], DataFrame]

# Parameters in place of dates and names of the day.
WIKIS = ["enwiki", "dewiki"]
HISTORY_WIKIS = ["commonswiki", "wikidatawiki", "enwiki", "dewiki"]
REQUESTED_WIKIS = ["enwiki", "nosuchwiki", "dewiki"]
PAGE = ("wikidatawiki", "Page 51")
PAGES = [("wikidatawiki", "Page 51"), ("commonswiki", "Page 7"), ("enwiki", "Template talk:Page 12")]
BREAKDOWN_START = "2024-01-16"
TREND_START, TREND_END = dt.date(2024, 1, 8), dt.date(2024, 1, 15)
SINCE = "2024-01-05"
HISTORY_FROM, HISTORY_TO = dt.date(2024, 1, 9), dt.datetime(2024, 1, 31)
AS_OF = "2024-01-31 00:00:00"
MERGE_BOUNDARY = "2024-01-15 12:34:00"
STREAM_CUTS = ["2024-01-08 10:20:30", MERGE_BOUNDARY, "2024-01-22 00:04:59"]
DUMP_MAX_AGE = 14
COLOURS = 10
SLICE_EVENTS = 5
USER = "u7"

_dump_folders: dict[tuple, str] = {}
_stored_tables: dict[tuple, tuple[str, str]] = {}
_second_tables: dict[tuple, str] = {}


def _version(spark: SparkSession, folder: str) -> tuple:
    """What tables written once a session are kept by: the session, the folder and the state of its events."""
    return (spark.sparkContext.applicationId, folder, files.fingerprint(spark, f"{folder}/events.parquet"))


def plain_times(result: DataFrame) -> DataFrame:
    """Times as UTC wall-clock ones, as the given tables have them."""
    times = [name for name, kind in result.dtypes if kind == "timestamp"]
    return result.withColumns({name: F.col(f"`{name}`").cast("timestamp_ntz") for name in times})


def dump_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All events, repetitions and test events included, as lines of daily dumps.

    Each 500th event is followed by a line cut off in the middle.
    """
    events = mapping.with_repeats(mapping.source_events(spark, folder))
    ts = "date_trunc('MILLISECOND', ts) AS ts_event_meta_dt"
    broken = F.col("_number") % 500 == 0
    lines = mapping.json_lines(mapping.to_staged(events, ts, "event_id AS _number"))
    whole_and_cut = F.when(broken, F.array("value", F.substring("value", 1, 20))).otherwise(F.array("value"))
    started = slices.with_slice_start(lines)
    return started.select(
        F.date_format("slice_start", "'stream_'yyyyMMdd'T000500'").alias("dump"),
        F.col("ts_event_meta_dt").alias("ts"),
        F.col("event_meta_id").alias("message"),
        F.explode(whole_and_cut).alias("value"),
    )


def dump_folder(spark: SparkSession, folder: str) -> str:
    """The dumps of a data folder, written once per session to the shared scratch folder."""
    key = _version(spark, folder)
    if key not in _dump_folders:
        out = scratch_dir(spark, "dumps")
        dumps.write_dumps(dump_lines(spark, folder), out, order=("ts", "message"))
        _dump_folders[key] = out
    return _dump_folders[key]


def stored_table(spark: SparkSession, folder: str) -> DataFrame:
    """The event table of a data folder, written once per session, partitioned by day and wiki group."""
    return tables.read_changes(spark, _stored(spark, folder)[0])


def stored_rollup(spark: SparkSession, folder: str, edits_only: bool = False) -> DataFrame:
    """One of the rollups of that table, written with it."""
    return tables.read_rollup(spark, _stored(spark, folder)[1], edits_only)


def _stored(spark: SparkSession, folder: str) -> tuple[str, str]:
    key = _version(spark, folder)
    if key not in _stored_tables:
        target, out = scratch_dir(spark, "table"), scratch_dir(spark, "rollups")
        tables.append_changes(mapping.event_table(spark, folder), target)
        rollups.refresh_rollups(spark, target, out)
        _stored_tables[key] = (target, out)
    return _stored_tables[key]


def file_names(spark: SparkSession, folder: str) -> DataFrame:
    """A file name per event: most are those of dumps, others break one rule each."""
    number = F.col("event_id")
    day_and_time = F.date_format("ts", "yyyyMMdd'T'HHmmss")
    stamp = (
        F.when(number % 13 == 0, F.concat(day_and_time, F.lit("0")))
        .when(number % 17 == 0, F.regexp_replace(day_and_time, "^202401", "202499"))
        .otherwise(day_and_time)
    )
    prefix = F.when(number % 5 == 0, "xstream_").otherwise("stream_")
    suffix = F.when(number % 7 == 0, ".gz").when(number % 11 == 0, ".gz.readyX").otherwise(".gz.ready")
    name = F.concat(prefix, stamp, F.lit("_"), F.lpad(number.cast("string"), 9, "0"), suffix)
    return mapping.source_events(spark, folder).select(name.alias("filename"))


def registry_facts(spark: SparkSession, folder: str) -> DataFrame:
    """A registry log with a fact per event, about the dump of its hour."""
    kinds = {"signup": "registered", "click": "load_begin", "view": "load_complete", "purchase": "archived"}
    fact = F.lit("transferred")
    for source, kind in kinds.items():
        fact = F.when(F.col("event_type") == source, kind).otherwise(fact)
    events = mapping.source_events(spark, folder)
    loaded = F.col("event_type") == "view"
    return events.select(
        F.date_format("ts", "'stream_'yyyyMMdd'T'HH'0500_000001.gz.ready'").alias("filename"),
        fact.alias("fact"),
        F.col("ts").cast("timestamp").alias("at"),
        F.when(loaded, F.col("event_id")).alias("events_in_file"),
        F.when(loaded, F.col("user_id")).alias("events_merged"),
    ).select(*REGISTRY_SCHEMA.fieldNames())


# Sources, sinks and stages of the load


def q_read_dumps(spark, d):
    lines = dumps.read_lines(spark, dump_folder(spark, d), glob="*.gz")
    return lines.groupBy(load.file_name().alias("filename")).agg(F.count(F.lit(1)).alias("lines"))


def q_parse_changes(spark, d):
    return staging.parse_changes(dump_lines(spark, d)).select(*STAGED_COLUMNS)


def q_select_ready_dumps(spark, d):
    return retention.parse_dump_names(file_names(spark, d))


def q_expired_dumps(spark, d):
    return retention.expired_dumps(file_names(spark, d), AS_OF, DUMP_MAX_AGE)


def q_load_registry(spark, d):
    return registry.registry_state(registry_facts(spark, d))


def q_compacted_registry(spark, d):
    """The log of all facts in parts, made compact after each."""
    path = scratch_dir(spark, "registry")
    for part in range(2):
        facts = registry_facts(spark, d).where(F.pmod(F.hash("at"), F.lit(2)) == part)
        registry.record_facts(facts, path)
        registry.compact_registry(spark, path)
    return registry.registry_state(tables.read_registry(spark, path))


def q_new_dumps(spark, d):
    """Dumps of all hours against the facts known at one point in time."""
    facts = registry_facts(spark, d)
    known = facts.where(F.col("at") < F.lit(MERGE_BOUNDARY).cast("timestamp"))
    return retention.new_dumps(facts.select("filename").distinct(), known)


def q_add_content_key(spark, d):
    return mapping.keyed(spark, d)


def q_parse_event_time(spark, d):
    staged = mapping.to_staged(mapping.source_events(spark, d))
    return staged.select(
        "event_meta_dt", event_time(F.col("event_meta_dt")).alias("ts_event_meta_dt")
    )


def q_dedup_changes(spark, d):
    return staging.dedup_changes(mapping.keyed(spark, d))


def _merge_twice(spark, d, target):
    """The events up to a time into a new table, then all of them."""
    tables.ensure_table(spark, target)
    batch = staging.dedup_changes(mapping.keyed(spark, d))
    first = batch.where(F.col(filters.TS) < F.lit(MERGE_BOUNDARY).cast("timestamp"))
    for name, part in (("first", first), ("second", batch)):
        stored = scratch_dir(spark, "batch")
        part.withColumn("load_id", F.lit(name)).write.parquet(stored)
        staging.merge_changes(spark.read.schema(_loaded_schema()).parquet(stored), target)


def _loaded_schema():
    wanted = [*EVENT_COLUMNS, "load_id"]
    return type(tables.TABLE_SCHEMA)([tables.TABLE_SCHEMA[c] for c in wanted])


def q_merge_changes(spark, d):
    target = scratch_dir(spark, "table")
    _merge_twice(spark, d, target)
    return tables.read_table(spark, target).select("_h", "event_meta_id", "load_id")


def q_load_batch(spark, d):
    target = scratch_dir(spark, "table")
    load.load_batch(spark, dump_folder(spark, d), target, glob="*.gz")
    return tables.read_changes(spark, target).select(*EVENT_COLUMNS)


def _loads_out_of_order(spark, d) -> str:
    """A table from two loads, the later days first, and a part of a third one that died in its write."""
    target = scratch_dir(spark, "table")
    days = sorted(r["path"] for r in dumps.list_dumps(spark, dump_folder(spark, d), "*.gz").select("path").collect())
    half = len(days) // 2
    for part in (days[half:], days[:half]):
        load.load_batch(spark, part, target, glob=None)
    torn = mapping.event_table(spark, d).where("event_id % 3 = 0")
    tables.append_changes(torn.withColumns({"load_id": F.lit("died"), "load_file": F.lit("x")}), target)
    return target


def q_committed_changes(spark, d):
    return tables.read_changes(spark, _loads_out_of_order(spark, d)).select(*EVENT_COLUMNS)


def q_committed_rollups(spark, d):
    """Both rollups from the counts that came with the loads, folded once; no event is read again."""
    target = _loads_out_of_order(spark, d)
    commits.fold_counts(spark, target)
    return commits.committed_rollups(spark, target)


def q_load_stats(spark, d):
    target = scratch_dir(spark, "table")
    stats = load.load_batch(spark, dump_folder(spark, d), target, glob="*.gz")
    return stats.select("filename", "lines", "staged", "deduplicated", "merged")


def q_partitioned_event_sink(spark, d):
    target = scratch_dir(spark, "table")
    tables.append_changes(mapping.event_table(spark, d), target)
    stored = tables.read_changes(spark, target)
    return stored.groupBy("event_date", "wiki_group").agg(F.count(F.lit(1)).alias("c"))


def q_export_epochs(spark, d):
    folder = scratch_dir(spark, "epochs")
    epochs.export_epochs(mapping.event_table(spark, d), folder)
    return spark.read.text(folder).select(F.col("value").alias("e"))


def q_read_epochs(spark, d):
    folder = scratch_dir(spark, "epochs")
    epochs.export_epochs(mapping.event_table(spark, d), folder)
    return epochs.read_epochs(spark, folder)


def q_dump_quality(spark, d):
    return load.dump_quality(dumps.read_lines(spark, dump_folder(spark, d), glob="*.gz"))


def q_first_event_time(spark, d):
    return load.first_event_time(dumps.read_lines(spark, dump_folder(spark, d), glob="*.gz"))


# Filters and projections


def _shown(changes: DataFrame) -> DataFrame:
    return changes.select("event_meta_id", "event_wiki", "event_type", "event_title", "event_bot")


def q_edits_only(spark, d):
    return _shown(filters.edits_only(mapping.event_table(spark, d)))


def q_wiki_filter(spark, d):
    return _shown(filters.wiki_filter(stored_table(spark, d), "enwiki"))


def q_page_filter(spark, d):
    return _shown(filters.page_filter(stored_table(spark, d), *PAGE))


def q_exclude_title_prefixes(spark, d):
    return _shown(filters.exclude_title_prefixes(mapping.event_table(spark, d)))


def q_since_filter(spark, d):
    return _shown(filters.since_filter(stored_table(spark, d), SINCE))


def q_since_filter_strict(spark, d):
    return _shown(filters.since_filter(stored_table(spark, d), SINCE, strict=True))


def q_date_range_filter(spark, d):
    return filters.date_range_filter(stored_rollup(spark, d, edits_only=True), TREND_START, TREND_END)


def q_clamp_date_range(spark, d):
    start, end = filters.clamp_date_range(TREND_END, TREND_END)
    return filters.date_range_filter(stored_rollup(spark, d, edits_only=True), start, end)


def q_exclude_bots(spark, d):
    return _shown(filters.exclude_bots(mapping.event_table(spark, d)))


def q_complete_hours_only(spark, d):
    return _shown(filters.complete_hours_only(mapping.event_table(spark, d)))


def q_known_wikis(spark, d):
    return filters.known_wikis(REQUESTED_WIKIS, trends.wiki_list_raw(mapping.event_table(spark, d)))


def q_wiki_in_list(spark, d):
    return _shown(filters.wiki_in_list(mapping.event_table(spark, d), WIKIS))


def q_drop_canary(spark, d):
    staged = mapping.to_staged(mapping.source_events(spark, d))
    return filters.drop_canary(staged).select("event_meta_id", "event_meta_domain")


def q_drop_undecodable(spark, d):
    return staging.drop_undecodable(dump_lines(spark, d)).select("message")


def q_watch_user(spark, d):
    return _shown(filters.watch_user(mapping.event_table(spark, d), USER))


def q_date_hour_keys(spark, d):
    keyed = rollups.date_hour_keys(mapping.event_table(spark, d))
    return keyed.select("event_meta_id", "date", "hour")


def q_hour_timestamp(spark, d):
    rollup = q_hourly_counts_all(spark, d)
    t = hour_timestamp(F.col("date"), F.col("hour"))
    return rollup.select("date", "hour", "event_wiki", t.alias("ts"))


def q_hours_before(spark, d):
    history = trends.page_history_filled(mapping.event_table(spark, d), *PAGE)
    reference = F.lit(AS_OF).cast("timestamp")
    return history.select("t", hours_before(F.col("t"), reference).alias("hours"), "value")


def _with_bots(spark, d):
    return breakdown.wiki_breakdown(stored_rollup(spark, d), start=BREAKDOWN_START)


def q_label_other(spark, d):
    return breakdown.label_other(_with_bots(spark, d)).select("event_wiki", "sum", "cumsum")


def q_drop_null_wiki(spark, d):
    labelled = breakdown.drop_null_wiki(breakdown.label_other(_with_bots(spark, d)))
    return labelled.select("event_wiki", "sum", "cumsum")


def q_stable_bucket(spark, d):
    wikis = breakdown.drop_null_wiki(trends.top_counts(mapping.event_table(spark, d), "event_wiki"))
    return breakdown.with_stable_bucket(wikis, COLOURS)


def q_series_label(spark, d):
    """Pages without wiki or title are labelled by what they have."""
    label = series_label(F.col("event_wiki"), F.col("event_title"))
    return mapping.event_table(spark, d).groupBy(label.alias("series")).agg(F.count(F.lit(1)).alias("c"))


def q_bot_flags(spark, d):
    return mapping.event_table(spark, d).select("event_meta_id", *bot_flags(F.col("event_bot")))


# Rollups, trends, status


def q_hourly_counts_all(spark, d):
    return rollups.hourly_counts(mapping.event_table(spark, d))


def q_hourly_counts_edits(spark, d):
    return rollups.hourly_counts(mapping.event_table(spark, d), edits_only=True)


def q_refresh_rollups(spark, d):
    """Both stored rollups: a full refresh on part of the events, a partial one after the rest."""
    changes = mapping.event_table(spark, d)
    target, out = scratch_dir(spark, "table"), scratch_dir(spark, "rollups")
    boundary = F.lit(MERGE_BOUNDARY).cast("timestamp")
    tables.append_changes(changes.where(F.col(filters.TS) < boundary), target)
    rollups.refresh_rollups(spark, target, out)
    rest = changes.where(F.col(filters.TS) >= boundary)
    tables.append_changes(rest, target)
    # One row per day.
    days = [r["day"] for r in rest.select(F.to_date(filters.TS).alias("day")).distinct().collect()]
    rollups.refresh_rollups(spark, target, out, days)
    return tables.read_rollups(spark, out)


def q_wiki_hourly_edits(spark, d):
    return trends.wiki_hourly_edits(mapping.event_table(spark, d), "enwiki")


def q_page_hourly_edits(spark, d):
    return trends.page_hourly_edits(mapping.event_table(spark, d), *PAGE)


def q_top_wikis(spark, d):
    return trends.top_wikis(mapping.event_table(spark, d))


def q_event_types(spark, d):
    return trends.event_types(mapping.event_table(spark, d))


def q_wiki_list_rollup(spark, d):
    return trends.wiki_list_rollup(stored_rollup(spark, d, edits_only=True))


def q_wiki_list_raw(spark, d):
    return trends.wiki_list_raw(mapping.event_table(spark, d))


def q_timetrend_rollup(spark, d):
    rollup = stored_rollup(spark, d, edits_only=True)
    return trends.timetrend_rollup(rollup, WIKIS, start=TREND_START, end=TREND_END)


def q_timetrend_rollup_nobots(spark, d):
    rollup = stored_rollup(spark, d, edits_only=True)
    return trends.timetrend_rollup(rollup, WIKIS, with_bots=False, start=TREND_START, end=TREND_END)


def q_timetrend_raw(spark, d):
    return trends.timetrend_raw(mapping.event_table(spark, d), WIKIS)


def q_timetrend_raw_nobots(spark, d):
    return trends.timetrend_raw(mapping.event_table(spark, d), WIKIS, with_bots=False)


def q_busiest_hours(spark, d):
    return trends.busiest_hours(mapping.event_table(spark, d))


def q_daily_rates(spark, d):
    return trends.daily_rates(mapping.event_table(spark, d))


def q_top_pages(spark, d):
    return trends.top_pages(stored_table(spark, d), "enwiki", SINCE)


def q_breakdown_sums(spark, d):
    return breakdown.breakdown_sums(stored_rollup(spark, d), BREAKDOWN_START)


def q_breakdown_totals(spark, d):
    return breakdown.breakdown_totals(q_breakdown_sums(spark, d))


def q_breakdown_segments(spark, d):
    return breakdown.breakdown_segments(_with_bots(spark, d))


def q_oldest_event(spark, d):
    return status.oldest_event(mapping.event_table(spark, d))


def q_newest_event(spark, d):
    return status.newest_event(mapping.event_table(spark, d), "Europe/Berlin")


def q_freshness_age(spark, d):
    return status.freshness_age(mapping.event_table(spark, d), AS_OF)


def q_event_count(spark, d):
    return status.event_count(mapping.event_table(spark, d))


def q_stored_extent(spark, d):
    """Oldest and newest event of the stored table, out of its outermost days."""
    return extent.stored_extent(spark, _stored(spark, d)[0])


def q_stored_complete_hours(spark, d):
    return _shown(extent.stored_complete_hours(spark, _stored(spark, d)[0]))


def q_db_stats(spark, d):
    return status.db_stats(mapping.event_table(spark, d), AS_OF)


def q_duplicate_meta_ids(spark, d):
    return status.duplicate_meta_ids(mapping.keyed(spark, d))


def q_rollup_consistency(spark, d):
    return rollups.rollup_consistency(mapping.event_table(spark, d), q_hourly_counts_all(spark, d))


def q_health_status(spark, d):
    return status.health_status(mapping.event_table(spark, d), AS_OF)


# Joins, windows, histories


def q_page_history_filled(spark, d):
    return trends.page_history_filled(stored_table(spark, d), *PAGE)


def q_page_history_many(spark, d):
    return trends.page_history(stored_table(spark, d), PAGES)


def q_wiki_history_many(spark, d):
    return trends.wiki_history_many(mapping.event_table(spark, d), HISTORY_WIKIS)


def q_top_pages_history(spark, d):
    changes = stored_table(spark, d)
    return trends.top_pages_history(changes, "enwiki", SINCE, HISTORY_FROM, HISTORY_TO)


def q_wiki_breakdown(spark, d):
    return _with_bots(spark, d).drop("total", "cum_total")


def q_wiki_breakdown_nobots(spark, d):
    rollup = q_hourly_counts_all(spark, d)
    return breakdown.wiki_breakdown(rollup, with_bots=False, start=BREAKDOWN_START).drop(
        "total", "cum_total"
    )


def q_burst_counts(spark, d):
    return bursts.burst_counts(mapping.event_table(spark, d))


def q_peak_burst(spark, d):
    return bursts.peak_burst(mapping.event_table(spark, d))


def q_burst_counts_forward(spark, d):
    return bursts.burst_counts_forward(mapping.event_table(spark, d))


def q_peak_burst_forward(spark, d):
    return bursts.peak_burst_forward(mapping.event_table(spark, d))


def second_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per second of the stored table, written with the first query that asks for them."""
    key = _version(spark, folder)
    if key not in _second_tables:
        out = scratch_dir(spark, "seconds")
        bursts.second_counts(stored_table(spark, folder)).write.parquet(out)
        _second_tables[key] = out
    return spark.read.schema("second bigint, n bigint").parquet(_second_tables[key])


def q_peak_burst_rollup(spark, d):
    return bursts.peak_from_seconds(second_rollup(spark, d), stored_table(spark, d), day_column="event_date")


def q_peak_burst_forward_rollup(spark, d):
    return bursts.peak_from_seconds(second_rollup(spark, d), stored_table(spark, d), forward=True, day_column="event_date")


# Streams


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The given events as a file stream, repetitions and test events included, with keys."""
    # A pattern, as a stream cannot start from the name of one file; the table may be a folder too.
    source = spark.readStream.schema(mapping.SOURCE_SCHEMA).parquet(f"{folder}/events.parquet*")
    staged = mapping.to_staged(mapping.with_repeats(source))
    return staging.add_content_key(staged).select(*EVENT_COLUMNS)


def _run(spark: SparkSession, stream: DataFrame) -> DataFrame:
    out, checkpoint = scratch_dir(spark, "stream"), scratch_dir(spark, "stream-state")
    jobs.run_to_folder(stream, out, checkpoint)
    return spark.read.schema(stream.schema).parquet(out)


def q_stream_load(spark, d):
    target, checkpoint = scratch_dir(spark, "table"), scratch_dir(spark, "stream-state")
    # The second run finds nothing new: the checkpoint knows the files.
    for _ in range(2):
        jobs.stream_load(spark, dump_folder(spark, d), target, checkpoint, glob="*.gz").awaitTermination()
    return tables.read_changes(spark, target).select(*EVENT_COLUMNS)


def q_stream_dedup(spark, d):
    return _run(spark, jobs.stream_dedup(event_stream(spark, d))).select(*EVENT_COLUMNS)


def q_dump_slices(spark, d):
    cut = slices.dump_slices(mapping.event_table(spark, d), SLICE_EVENTS)
    return cut.select("event_meta_id", "slice_start", "slice_part")


def q_stream_hourly_counts(spark, d):
    return _run(spark, jobs.stream_hourly_counts(event_stream(spark, d)))


def q_stream_hourly_counts_edits(spark, d):
    return _run(spark, jobs.stream_hourly_counts(event_stream(spark, d), edits_only=True))


def q_stream_health(spark, d):
    """One row of state, which the memory sink holds."""
    out = scratch_dir(spark, "stream-state")
    name = "health_" + out[-32:]
    status_stream = jobs.stream_health(event_stream(spark, d), AS_OF)
    writer = status_stream.writeStream.format("memory").queryName(name).outputMode("complete")
    writer.option("checkpointLocation", out).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


def q_stream_health_timeout(spark, d):
    """The state turns to OK by the events, and to ERROR a second after them; the memory sink holds two rows."""
    out = scratch_dir(spark, "stream-state")
    name = "health_timeout_" + out[-32:]
    changes = health.stream_health_timeout(event_stream(spark, d), max_age=1)
    writer = changes.writeStream.format("memory").queryName(name).outputMode("append")
    query = writer.option("checkpointLocation", out).trigger(processingTime="200 milliseconds").start()
    try:
        while query.isActive and spark.table(name).where("status = 'ERROR'").isEmpty():
            time.sleep(0.2)
        if failure := query.exception():
            raise failure
    finally:
        query.stop()
    return spark.table(name).select("status", "last_event")


def in_turn(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    """A stream that brings some tables one after the other, each as a batch."""
    folder = scratch_dir(spark, "stream-source")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(folder)


def q_stream_dump_slices(spark, d):
    """The events in four batches, one after the other in time."""
    changes = mapping.event_table(spark, d).withColumn(filters.TS, F.col(filters.TS).cast("timestamp"))
    cuts = ["1970-01-01", *STREAM_CUTS, "9999-01-01"]
    between = [(F.col(filters.TS) >= F.lit(a).cast("timestamp")) & (F.col(filters.TS) < F.lit(b).cast("timestamp")) for a, b in zip(cuts, cuts[1:])]
    stream = in_turn(spark, [changes.where(span) for span in between])
    out, checkpoint = scratch_dir(spark, "stream"), scratch_dir(spark, "stream-state")
    batches.stream_dump_slices(stream, out, checkpoint, SLICE_EVENTS).awaitTermination()
    return batches.sliced(spark, out, stream.schema).select("event_meta_id", "slice_start", "slice_part")


def q_stream_late_rows(spark, d):
    """What is too late if the later events come first; those in time are de-duplicated elsewhere."""
    keyed = mapping.keyed(spark, d).withColumn(filters.TS, F.col(filters.TS).cast("timestamp"))
    boundary = F.lit(MERGE_BOUNDARY).cast("timestamp")
    stream = in_turn(spark, [keyed.where(F.col(filters.TS) >= boundary), keyed.where(F.col(filters.TS) < boundary)])
    late, checkpoint = scratch_dir(spark, "late"), scratch_dir(spark, "stream-state")
    batches.stream_split_late(stream, lambda rows, batch: None, late, checkpoint).awaitTermination()
    return batches.late_table(spark, late, stream.schema).select("event_meta_id", filters.TS)


def q_stream_watch_user(spark, d):
    return _shown(_run(spark, jobs.stream_watch_user(event_stream(spark, d), USER)))


def q_flagship(spark, d):
    """Raw events to hourly counts: key, de-duplicate, count the complete hours."""
    return rollups.hourly_counts(staging.dedup_changes(mapping.keyed(spark, d)))


def registered() -> dict[str, Query]:
    """Query name to callable; all functions of this module called `q_<name>`."""

    def wrap(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain_times(query(spark, folder))

        return run

    return {name[2:]: wrap(query) for name, query in globals().items() if name.startswith("q_")}
