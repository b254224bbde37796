"""From lines of text to new rows of the event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from changetide.functions.columns import content_key, event_time
from changetide.schema import CANARY_DOMAIN, EVENT_COLUMNS, LINE_SCHEMA, STAGED_COLUMNS
from changetide.sources.tables import append_changes, read_table, with_partitions


def _one_element(value: Column) -> Column:
    """The line as the only element of a JSON list: text after the object makes it malformed."""
    return F.concat(F.lit("["), value, F.lit("]"))


def inspect_lines(lines: DataFrame) -> DataFrame:
    """Every line with what could be read from it.

    Adds `decodable`, `has_meta`, `corrupt_text` (the line, if a field had the wrong type) and the
    nine staged columns. A generator parses the text exactly once; a plain projection would be
    evaluated again by each filter pushed below it.
    """
    parsed = F.from_json(_one_element(F.col("value")), LINE_SCHEMA, {"allowSingleQuotes": "false"})
    opened = lines.select("*", F.inline(F.array(F.struct(parsed.alias("_objects")))))
    one = F.when(F.size("_objects") == 1, F.get("_objects", F.lit(0)))
    event_id = one["id"].try_cast("bigint")
    bot = F.when(one["bot"] == "true", F.lit(True)).when(one["bot"] == "false", F.lit(False))
    ill_typed = (one["id"].isNotNull() & event_id.isNull()) | (one["bot"].isNotNull() & bot.isNull())
    # Only text that is no object comes here with no list: numbers, strings and lists are JSON too.
    other_json = ~F.ltrim("value").startswith("{") & F.get_json_object(
        _one_element(F.col("value")), "$"
    ).isNotNull()
    decodable = F.when(F.col("_objects").isNotNull(), F.size("_objects") == 1).otherwise(other_json)
    return opened.select(
        *lines.columns,
        F.coalesce(decodable, F.lit(False)).alias("decodable"),
        F.coalesce(one["meta"].isNotNull(), F.lit(False)).alias("has_meta"),
        F.when(ill_typed, F.col("value")).alias("corrupt_text"),
        one["meta"]["dt"].alias("event_meta_dt"),
        one["meta"]["id"].alias("event_meta_id"),
        one["meta"]["domain"].alias("event_meta_domain"),
        event_id.alias("event_id"),
        one["type"].alias("event_type"),
        one["wiki"].alias("event_wiki"),
        one["user"].alias("event_user"),
        bot.alias("event_bot"),
        one["title"].alias("event_title"),
    )


def parse_changes(lines: DataFrame) -> DataFrame:
    """Staged events: lines that are JSON and have `meta`; what is missing is NULL.

    A field of the wrong type is NULL and its line is kept in `corrupt_text`; a `meta` that is no
    object counts as missing.
    """
    carried = [c for c in lines.columns if c != "value"]
    staged = inspect_lines(lines).where("has_meta")
    return staged.select(*carried, *STAGED_COLUMNS, "corrupt_text")


def drop_undecodable(lines: DataFrame) -> DataFrame:
    """Lines that are JSON at all, unchanged."""
    return inspect_lines(lines).where("decodable").select(*lines.columns)


def add_content_key(staged: DataFrame) -> DataFrame:
    """Adds the content key `_h` and the event time; no row is dropped."""
    return staged.withColumns(
        {
            "_h": content_key(
                F.col("event_meta_id"), F.col("event_meta_dt"), F.col("event_id"), F.col("event_user")
            ),
            "ts_event_meta_dt": event_time(F.col("event_meta_dt")),
        }
    )


def dedup_changes(keyed: DataFrame, first: tuple[str, ...] = ()) -> DataFrame:
    """One row per content key, without test events and events of unknown domain.

    Of several rows of a key those with a real domain come first, so a test event never stands in for
    a real one; which of them stays is fixed by the order of `first` and then of all event columns.
    With the file name in `first` that is what loading the files in turn would leave.
    `row_number() = 1` is computed as a group limit on both sides of the shuffle, so of a key
    repeated a billion times each task sends one row.
    """
    real = F.coalesce(F.col("event_meta_domain") != CANARY_DOMAIN, F.lit(False))
    order = [real.desc(), *(F.col(c).asc_nulls_first() for c in (*first, *EVENT_COLUMNS[1:]))]
    numbered = keyed.withColumn("_rn", F.row_number().over(Window.partitionBy("_h").orderBy(*order)))
    kept = numbered.where((F.col("_rn") == 1) & (F.col("event_meta_domain") != CANARY_DOMAIN))
    return kept.drop("_rn")


def batch_ranges(batch: DataFrame) -> DataFrame:
    """Per partition day of a batch: lowest and highest event text, and whether one is missing."""
    return batch.groupBy("event_date").agg(
        F.min("event_meta_dt").alias("lo"),
        F.max("event_meta_dt").alias("hi"),
        F.bool_or(F.col("event_meta_dt").isNull()).alias("has_null"),
    )


def _neighbours(ranges: list) -> list[tuple]:
    """Lowest and highest text of each run of days without a gap; text sorts as its day does."""
    runs: list[list] = []
    for r in sorted((r for r in ranges if r["event_date"] and r["lo"] is not None), key=lambda r: r["event_date"]):
        if runs and (r["event_date"] - runs[-1][0]).days <= 1:
            runs[-1] = [r["event_date"], min(runs[-1][1], r["lo"]), max(runs[-1][2], r["hi"])]
        else:
            runs.append([r["event_date"], r["lo"], r["hi"]])
    return [(lo, hi) for _, lo, hi in runs]


def possible_matches(table: DataFrame, ranges: list) -> DataFrame:
    """Rows of the table that can share a key with a batch having those `batch_ranges`.

    The event text is part of the key, so equal keys have the same text and the same day: only the
    batch's days are read, and of them only the text ranges of neighbouring days together. Events
    whose text is no date share one partition. (Key parts are joined by separators; texts forged
    to give the same joined text with other parts could escape the restriction.)
    """
    text, day = F.col("event_meta_dt"), F.col("event_date")
    keep = F.lit(False)
    if days := [r["event_date"] for r in ranges if r["event_date"] is not None]:
        inside = F.lit(False)
        for lo, hi in _neighbours(ranges):
            inside = inside | text.between(lo, hi)
        keep = day.isin(days) & inside
    for r in ranges:
        if r["event_date"] is None:
            same = text.between(r["lo"], r["hi"]) if r["lo"] is not None else F.lit(False)
            keep = keep | (day.isNull() & (same | text.isNull() if r["has_null"] else same))
    return table.where(keep)


def unseen_changes(batch: DataFrame, table: DataFrame, ranges: list) -> DataFrame:
    """Rows of a de-duplicated batch whose key the table does not have.

    The batch comes out of `dedup_changes` hashed by `_h`, so only the keys of the table move.
    """
    known = possible_matches(table, ranges).select("_h")
    return batch.join(known, "_h", "left_anti")


def merge_changes(batch: DataFrame, path: str, ranges: list | None = None, known: DataFrame | None = None) -> None:
    """Append to the table at `path` the rows of a de-duplicated batch that are not in it.

    Loading the same rows again adds nothing. `ranges` are the collected `batch_ranges` (one row
    per calendar day); without them they are taken from the batch, which is then computed twice,
    so hand in stored rows. `known` are the rows of the table that count, by default all.
    """
    spark: SparkSession = batch.sparkSession
    if ranges is None:
        ranges = batch_ranges(with_partitions(batch)).collect()
    append_changes(unseen_changes(batch, read_table(spark, path) if known is None else known, ranges), path)
