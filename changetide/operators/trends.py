"""Counts over time, top lists and gap-free page histories."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from changetide.functions.columns import at, hour_start, hour_timestamp, series_label
from changetide.operators.filters import (
    TS,
    complete_hours_only,
    count_column,
    date_range_filter,
    edits_only,
    exclude_bots,
    exclude_title_prefixes,
    page_filter,
    since_filter,
    wiki_filter,
    wiki_in_list,
)
from changetide.schema import EXCLUDED_TITLE_PREFIXES

#: Hours of an axis that one row holds at a time.
_AXIS_BLOCK = 8_760


def _count_by_hour(events: DataFrame, *keys: str) -> DataFrame:
    return events.groupBy(*keys, hour_start(F.col(TS)).alias("t")).agg(F.count(F.lit(1)).alias("c"))


def _date_hour_count(by_hour: DataFrame) -> DataFrame:
    return by_hour.select(F.to_date("t").alias("date"), F.hour("t").alias("hour"), "c")


def wiki_hourly_edits(changes: DataFrame, wiki: str = "enwiki") -> DataFrame:
    """Edits of one wiki per date and hour, in order; hours without edits are absent."""
    by_hour = _count_by_hour(wiki_filter(edits_only(changes), wiki))
    return _date_hour_count(by_hour).orderBy("date", "hour")


def page_hourly_edits(changes: DataFrame, wiki: str, title: str) -> DataFrame:
    """Edits of one page per date and hour, in order; hours without edits are absent."""
    by_hour = _count_by_hour(page_filter(edits_only(changes), wiki, title))
    return _date_hour_count(by_hour).orderBy("date", "hour")


def top_counts(changes: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Events per value of a column, most first; ties by value, a missing value last."""
    counts = changes.groupBy(column).agg(F.count(F.lit(1)).alias("c"))
    ordered = counts.orderBy(F.desc("c"), F.asc_nulls_last(column))
    return ordered if n is None else ordered.limit(n)


def top_wikis(changes: DataFrame, n: int = 10) -> DataFrame:
    return top_counts(changes, "event_wiki", n)


def event_types(changes: DataFrame) -> DataFrame:
    return top_counts(changes, "event_type")


def wiki_list_rollup(edits_rollup: DataFrame) -> DataFrame:
    """Wikis by number of edits, out of the rollup of edits (complete hours)."""
    counts = edits_rollup.groupBy("event_wiki").agg(F.sum("count_bot_flagignore").alias("c"))
    return counts.orderBy(F.desc("c"), F.asc_nulls_last("event_wiki"))


def wiki_list_raw(changes: DataFrame) -> DataFrame:
    """Wikis by number of edits, counting events (the last, incomplete hour included)."""
    return top_counts(edits_only(changes), "event_wiki")


def _trend(rows: DataFrame, hour: Column, wikis: list[str], amount: Column) -> DataFrame:
    """One column per wiki: NULL, not 0, in hours without a row of that wiki.

    Summing under a condition needs one aggregation; `pivot` would plan two.
    """
    columns = [F.sum(F.when(F.col("event_wiki") == w, amount)).alias(w) for w in wikis]
    by_hour = rows.groupBy(hour.alias("ts")).agg(*columns)
    return by_hour.select(
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        *[F.col(f"`{w}`") for w in wikis],
        "ts",
    ).orderBy("ts")


def timetrend_rollup(
    edits_rollup: DataFrame,
    wikis: list[str],
    with_bots: bool = True,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Edits per hour of the selected wikis, side by side, out of the rollup of edits."""
    rows = date_range_filter(wiki_in_list(edits_rollup, wikis), start, end)
    hour = hour_timestamp(F.col("date"), F.col("hour"))
    return _trend(rows, hour, wikis, F.col(count_column(with_bots)))


def timetrend_raw(
    changes: DataFrame, wikis: list[str], with_bots: bool = True, whole: DataFrame | None = None
) -> DataFrame:
    """The same out of the events.

    Here an hour in which only bots edited is absent (or NULL for that wiki) without bots, where
    the rollup gives 0.
    """
    rows = edits_only(complete_hours_only(changes, whole))
    if not with_bots:
        rows = exclude_bots(rows)
    return _trend(wiki_in_list(rows, wikis), hour_start(F.col(TS)), wikis, F.lit(1))


def busiest_hours(changes: DataFrame, n: int = 10) -> DataFrame:
    by_hour = _count_by_hour(changes).orderBy(F.desc("c"), F.asc_nulls_last("t")).limit(n)
    return _date_hour_count(by_hour)


def daily_rates(changes: DataFrame) -> DataFrame:
    """Events and edits per second of each day (NULL on a day without edits), busiest day first."""
    seconds = F.lit(86400.0)
    by_day = changes.groupBy(F.to_date(TS).alias("date")).agg(
        (F.count(F.lit(1)) / seconds).alias("total_per_sec"),
        (F.sum(F.when(F.col("event_type") == "edit", 1)) / seconds).alias("edits_per_sec"),
    )
    return by_day.orderBy(F.desc("total_per_sec"), F.asc_nulls_last("date"))


def top_pages(
    changes: DataFrame,
    wiki: str = "enwiki",
    since: dt.datetime | str | None = None,
    n: int = 20,
    exclude: list[str] = EXCLUDED_TITLE_PREFIXES,
    strict: bool = False,
) -> DataFrame:
    """Titles of one wiki with most edits since a time."""
    edits = edits_only(wiki_filter(since_filter(changes, since, strict), wiki))
    titles = exclude_title_prefixes(edits, exclude)
    counts = titles.groupBy("event_title").agg(F.count(F.lit(1)).alias("c"))
    return counts.orderBy(F.desc("c"), "event_title").limit(n)


def _checked_bound(bound: object) -> Column:
    if bound is None:
        return F.lit(None).cast("timestamp")
    if not isinstance(bound, dt.date):
        raise ValueError("a time range bound must be a date or a datetime")
    return at(bound)


def page_specs(changes: DataFrame, pages: list[tuple]) -> DataFrame:
    """`(wiki, title[, tmin, tmax])` tuples as rows for `page_history`."""
    spark = changes.sparkSession
    rows = []
    for number, page in enumerate(pages):
        wiki, title, *bounds = page
        tmin, tmax = (*bounds, None, None)[:2]
        for bound in (tmin, tmax):
            if bound is not None and not isinstance(bound, dt.date):
                raise ValueError("a time range bound must be a date or a datetime")
        texts = [None if b is None else _bound_text(b) for b in (tmin, tmax)]
        rows.append((number, wiki, title, *texts))
    specs = spark.createDataFrame(
        rows, "series_no int, event_wiki string, event_title string, tmin string, tmax string"
    )
    return specs.withColumns(
        {"tmin": F.col("tmin").cast("timestamp"), "tmax": F.col("tmax").cast("timestamp")}
    )


def _bound_text(bound: dt.date) -> str:
    if isinstance(bound, dt.datetime):
        if bound.tzinfo is not None:
            bound = bound.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return bound.isoformat(sep=" ")
    return bound.isoformat()


def page_history(
    changes: DataFrame,
    pages: list[tuple] | DataFrame,
    tmin: dt.date | None = None,
    tmax: dt.date | None = None,
    fill: int = 0,
) -> DataFrame:
    """Edits per hour of any number of pages without gaps, in one job.

    `pages` are `(wiki, title[, tmin, tmax])` tuples, or rows `(series_no, event_wiki, event_title,
    tmin, tmax)`; `tmin` and `tmax` apply where a page has none of its own. A missing bound is the
    page's own first or last hour; a page with neither edits nor bounds has no rows. The series
    runs in steps of an hour from the lower bound while not past the upper one; hours outside of
    it are dropped, hours without edits get `fill`.
    """
    lower, upper = _checked_bound(tmin), _checked_bound(tmax)
    specs = pages if isinstance(pages, DataFrame) else page_specs(changes, pages)
    edits = edits_only(changes)
    if not isinstance(pages, DataFrame):
        edits = wiki_in_list(edits, sorted({p[0] for p in pages}))
    if bounds := _common_bounds(pages, tmin, tmax):
        edits = _between(edits, *bounds)
    page = ["event_wiki", "event_title"]
    listed = edits.join(specs.select(*page), page, "left_semi")
    counts = _count_by_hour(listed, *page).where(F.col("t").isNotNull())
    spanned = specs
    if not bounds and not (isinstance(pages, DataFrame) and tmin is not None and tmax is not None):
        spans = counts.groupBy(*page).agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"))
        spanned = specs.join(spans, page, "left")
        lower, upper = F.coalesce(lower, "first_t"), F.coalesce(upper, "last_t")
    axis = _hours(spanned.select("series_no", *page, F.coalesce("tmin", lower).alias("lo"), F.coalesce("tmax", upper).alias("hi")))
    filled = axis.join(counts, [*page, "t"], "left")
    return filled.select(
        "series_no",
        series_label(F.col("event_wiki"), F.col("event_title")).alias("series"),
        "t",
        F.coalesce("c", F.lit(fill)).alias("value"),
    )


def _common_bounds(pages: list[tuple] | DataFrame, tmin: dt.date | None, tmax: dt.date | None) -> tuple | None:
    """Lowest and highest time that any page asks for; None if some page lacks a bound."""
    if isinstance(pages, DataFrame):
        # Rows may bring bounds of their own, which are not known here.
        return None
    ranges = [((*p[2:], None, None)[0] or tmin, (*p[2:], None, None)[1] or tmax) for p in pages]
    if not ranges or any(a is None or b is None for a, b in ranges):
        return None
    lowest, highest = sorted(map(_moment, (a for a, _ in ranges)))[0], sorted(map(_moment, (b for _, b in ranges)))[-1]
    return lowest, highest


def _moment(bound: dt.date) -> dt.datetime:
    """A bound as a time of day in UTC without zone."""
    if not isinstance(bound, dt.datetime):
        return dt.datetime(bound.year, bound.month, bound.day)
    return bound.astimezone(dt.timezone.utc).replace(tzinfo=None) if bound.tzinfo else bound


def _between(events: DataFrame, lowest: dt.datetime, highest: dt.datetime) -> DataFrame:
    """Events of the hours from one time to another; the days are given to a partitioned table too."""
    start = lowest.replace(minute=0, second=0, microsecond=0)
    kept = since_filter(events, start).where(F.col(TS) < at(highest) + F.expr("INTERVAL 1 HOUR"))
    if "event_date" in events.columns:
        kept = kept.where(F.col("event_date") <= F.date_add(at(highest).cast("date"), 2))
    return kept


def _hours(spans: DataFrame) -> DataFrame:
    """The hours from `lo` in steps of one while not past `hi`, cut to whole hours, a row each: `t`.

    Reversed or missing bounds give no rows. Long spans are laid out in blocks, so no row ever holds
    more than a year of hours.
    """
    steps = F.floor((F.unix_micros("hi") - F.unix_micros("lo")) / 3_600_000_000)
    kept = spans.withColumn("_steps", steps).where(F.col("_steps") >= 0)
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_steps") / _AXIS_BLOCK)))
    blocks = kept.withColumn("_block", block).withColumn("_from", F.col("_block") * _AXIS_BLOCK)
    number = F.explode(F.sequence("_from", F.least(F.col("_from") + (_AXIS_BLOCK - 1), "_steps")))
    numbered = blocks.withColumn("_number", number)
    start = F.unix_micros(hour_start(F.col("lo")))
    t = F.timestamp_micros(start + F.col("_number") * 3_600_000_000)
    return numbered.withColumn("t", t).drop("lo", "hi", "_steps", "_block", "_from", "_number")


def page_history_filled(
    changes: DataFrame,
    wiki: str,
    title: str,
    tmin: dt.date | None = None,
    tmax: dt.date | None = None,
    fill: int = 0,
) -> DataFrame:
    """Edits per hour of one page without gaps, in order."""
    history = page_history(changes, [(wiki, title)], tmin, tmax, fill)
    return history.select("t", "value").orderBy("t")


def wiki_history_many(changes: DataFrame, wikis: list[str]) -> DataFrame:
    """Edits per hour of several wikis in one pass, labelled by wiki."""
    edits = wiki_in_list(edits_only(changes), wikis)
    return _count_by_hour(edits, "event_wiki").select(
        F.col("event_wiki").alias("series"), "t", F.col("c").alias("value")
    )


def top_pages_history(
    changes: DataFrame,
    wiki: str,
    since: dt.datetime | str | None,
    tmin: dt.date,
    tmax: dt.date,
    first: int = 10,
) -> DataFrame:
    """Histories of the most edited pages on a common time axis; `series_no` is the rank from 0."""
    if not isinstance(tmin, dt.date) or not isinstance(tmax, dt.date):
        raise ValueError("a time range bound must be a date or a datetime")
    if first < 1:
        raise ValueError("number of pages must be positive")
    top = top_pages(changes, wiki, since, n=first)
    # The limit has put its `first` rows in order in one place; they are numbered there.
    rank = F.row_number().over(Window.orderBy(F.desc("c"), "event_title")) - 1
    ranked = top.select(rank.alias("series_no"), "event_title")
    specs = ranked.select(
        "series_no",
        F.lit(wiki).alias("event_wiki"),
        "event_title",
        F.lit(None).cast("timestamp").alias("tmin"),
        F.lit(None).cast("timestamp").alias("tmax"),
    )
    within = _between(wiki_filter(changes, wiki), _moment(tmin), _moment(tmax))
    return page_history(within, specs, tmin, tmax)
