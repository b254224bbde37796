"""Shares of the wikis: sums, running sums, and the tail as one segment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from changetide.functions.columns import stable_bucket
from changetide.operators.filters import date_range_filter
from changetide.schema import OTHER_LABEL

_SUMS = {
    "sum_bot_flagignore": "count_bot_flagignore",
    "sum_bot_true": "count_bot_true",
    "sum_bot_false": "count_bot_false",
}
_TOTALS = {
    "tot_bot_flagignore": "sum_bot_flagignore",
    "tot_bot_true": "sum_bot_true",
    "tot_bot_false": "sum_bot_false",
}


def breakdown_sums(rollup: DataFrame, start: dt.date | str | None = None) -> DataFrame:
    """Per wiki the three counters, added up from a date on."""
    sums = [F.sum(column).alias(name) for name, column in _SUMS.items()]
    return date_range_filter(rollup, start).groupBy("event_wiki").agg(*sums)


def breakdown_totals(sums: DataFrame) -> DataFrame:
    return sums.agg(*[F.sum(column).alias(name) for name, column in _TOTALS.items()])


def wiki_breakdown(
    rollup: DataFrame, with_bots: bool = True, start: dt.date | str | None = None
) -> DataFrame:
    """Per wiki: sum, share, running sum and its share, largest wiki first.

    Without bots the share is taken of all events, and the running share of those not made by
    bots. `total` and `cum_total` are what the two shares refer to, as exact integers.
    """
    sums = breakdown_sums(rollup, start)
    counter = "sum_bot_flagignore" if with_bots else "sum_bot_false"
    # One row per wiki gets here, whatever the number of events, so windows over all are fine; the
    # totals come from the same rows and need no second pass and no join.
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.desc(counter), F.asc_nulls_last("event_wiki")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = sums.select(
        "event_wiki",
        F.col(counter).alias("sum"),
        F.sum(counter).over(order).alias("cumsum"),
        F.sum("sum_bot_flagignore").over(everything).alias("total"),
        F.sum(counter).over(everything).alias("cum_total"),
    )
    return rows.select(
        "event_wiki",
        "sum",
        F.try_divide("sum", "total").alias("rel_sum"),
        "cumsum",
        F.try_divide("cumsum", "cum_total").alias("rel_cumsum"),
        "total",
        "cum_total",
    )


def label_other(breakdown: DataFrame, percent: int = 95, label: str = OTHER_LABEL) -> DataFrame:
    """The wikis from the one on that reaches `percent` of the total get one common label.

    Compared in integers, so that a running share of exactly that many percent counts as reached.
    """
    tail = F.col("cumsum") * 100 >= F.col("cum_total") * percent
    return breakdown.withColumn("event_wiki", F.when(tail, F.lit(label)).otherwise(F.col("event_wiki")))


def drop_null_wiki(labelled: DataFrame) -> DataFrame:
    """To be applied to labelled rows: events without wiki may be part of the common label."""
    return labelled.where(F.col("event_wiki").isNotNull())


def breakdown_segments(breakdown: DataFrame, percent: int = 95) -> DataFrame:
    """Share per label, the data of the area chart: added up as counts and divided once."""
    labelled = drop_null_wiki(label_other(breakdown, percent))
    share = F.try_divide(F.sum("sum"), F.max("total"))
    return labelled.groupBy("event_wiki").agg(share.alias("rel_sum"))


def with_stable_bucket(rows: DataFrame, buckets: int, column: str = "event_wiki") -> DataFrame:
    """Adds `bucket`, which depends on the name only (a colour index, say)."""
    return rows.withColumn("bucket", stable_bucket(F.col(column), buckets))
