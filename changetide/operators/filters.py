"""Row filters. On the stored table they also name the partitions that can hold a match."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changetide.functions.columns import at, hour_start, wiki_group_of
from changetide.schema import CANARY_DOMAIN, EXCLUDED_TITLE_PREFIXES

TS = "ts_event_meta_dt"
# A time zone offset in the event text can move its UTC date by one day against `event_date`.
_OFFSET_DAYS = 1


def edits_only(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("event_type") == "edit")


def wiki_filter(changes: DataFrame, wiki: str) -> DataFrame:
    return wiki_in_list(changes, [wiki])


def wiki_in_list(changes: DataFrame, wikis: list[str]) -> DataFrame:
    """Events or rollup rows of the wikis named."""
    kept = changes.where(F.col("event_wiki").isin(list(wikis)))
    if "wiki_group" in changes.columns:
        kept = kept.where(F.col("wiki_group").isin(sorted({wiki_group_of(w) for w in wikis})))
    return kept


def page_filter(changes: DataFrame, wiki: str, title: str) -> DataFrame:
    return wiki_filter(changes, wiki).where(F.col("event_title") == title)


def exclude_title_prefixes(
    changes: DataFrame, prefixes: list[str] = EXCLUDED_TITLE_PREFIXES
) -> DataFrame:
    """Without titles of the given prefixes, and without events that have no title."""
    kept = changes.where(F.col("event_title").isNotNull())
    for prefix in prefixes:
        kept = kept.where(~F.col("event_title").startswith(prefix))
    return kept


def since_filter(changes: DataFrame, since: dt.datetime | str | None, strict: bool = False) -> DataFrame:
    """Events at or after `since` (`strict`: after it); None keeps all that have a time from 1900 on."""
    since = "1900-01-01" if since is None else since
    kept = changes.where(F.col(TS) > at(since) if strict else F.col(TS) >= at(since))
    if "event_date" in changes.columns:
        kept = kept.where(F.col("event_date") >= F.date_sub(at(since).cast("date"), _OFFSET_DAYS))
    return kept


def date_range_filter(
    rollup: DataFrame, start: dt.date | str | None = None, end: dt.date | str | None = None
) -> DataFrame:
    """Rows with `start <= date <= end`; each side may be left open."""
    if start is not None:
        rollup = rollup.where(F.col("date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        rollup = rollup.where(F.col("date") <= F.lit(str(end)).cast("date"))
    return rollup


def clamp_date_range(start: dt.date, end: dt.date) -> tuple[dt.date, dt.date]:
    """A range shorter than a day gets the day before its end as its start."""
    if start + dt.timedelta(days=1) > end:
        start = end - dt.timedelta(days=1)
    return start, end


def exclude_bots(changes: DataFrame) -> DataFrame:
    """Events flagged as not made by a bot; those without the flag go as well."""
    return changes.where(~F.col("event_bot"))


def count_column(with_bots: bool) -> str:
    """The rollup counter to use: the counterpart of `exclude_bots` for rollups."""
    return "count_bot_flagignore" if with_bots else "count_bot_false"


def last_hour_start(changes: DataFrame) -> Column:
    """Start of the hour of the newest event, as a scalar subquery over one column."""
    return changes.agg(hour_start(F.max(TS)).alias("cut")).scalar()


def complete_hours_only(changes: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """Without the last hour, which is still being filled.

    The newest event is looked for in `whole` (default: the same rows); give the unfiltered table
    when `changes` is a part of it. The subquery's value reaches the scan as a pushed filter.
    """
    return changes.where(F.col(TS) < last_hour_start(changes if whole is None else whole))


def drop_canary(changes: DataFrame) -> DataFrame:
    """Without test events; unlike the load, events of unknown domain stay."""
    return changes.where(~F.col("event_meta_domain").eqNullSafe(CANARY_DOMAIN))


def watch_user(changes: DataFrame, user: str) -> DataFrame:
    """Events of one user, batch or streaming."""
    return changes.where(F.col("event_user") == user)


def known_wikis(requested: list[str], available: DataFrame) -> DataFrame:
    """The requested wikis that exist in `available` (column `event_wiki`), with their position."""
    spark: SparkSession = available.sparkSession
    wanted = spark.createDataFrame(list(enumerate(requested)), "position int, event_wiki string")
    # The list typed in by a user is small: kept on the left, it is what the other side is cut to.
    present = available.where(F.col("event_wiki").isin(list(requested))).select("event_wiki")
    return wanted.join(present, "event_wiki", "left_semi").select("position", "event_wiki")


def require_known_wikis(requested: list[str], available: DataFrame) -> list[str]:
    """Names for the trend columns, in request order; ValueError if none is known."""
    rows = known_wikis(requested, available).orderBy("position").collect()
    if not rows:
        raise ValueError("none of the requested wikis exists")
    return [r["event_wiki"] for r in rows]
