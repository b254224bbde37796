"""Column expressions shared by the operators; all of them stay inside the JVM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from changetide.schema import OTHER_GROUP, WIKI_GROUPS


def _key_part(part: Column) -> Column:
    return F.concat(F.coalesce(part.cast("string"), F.lit("")), F.lit("_"))


def content_key(meta_id: Column, meta_dt: Column, event_id: Column, user: Column) -> Column:
    """MD5 over the four identifying fields; a missing field counts as empty text."""
    dash = F.lit("-")
    return F.md5(
        F.concat(
            _key_part(meta_id), dash, _key_part(meta_dt), dash, _key_part(event_id), dash, _key_part(user)
        )
    )


def event_time(text: Column) -> Column:
    """Event text to a timestamp with milliseconds; NULL for anything that is no date and time.

    The leading date is asked for because a bare time of day would be read as one of today.
    """
    parsed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))
    return F.date_trunc("MILLISECOND", parsed)


def key_date(text: Column) -> Column:
    """Partition date out of the event text, so that it is a function of the content key.

    Text that does not begin with a date gives NULL: the number of partitions is bounded by the
    calendar, whatever the text holds.
    """
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10).try_cast("date"))


def wiki_group(wiki: Column) -> Column:
    group = F.lit(OTHER_GROUP)
    for name, members in WIKI_GROUPS.items():
        group = F.when(wiki.isin(members), F.lit(name)).otherwise(group)
    return group


def wiki_group_of(wiki: str) -> str:
    """The partition a wiki is stored in, for pruning."""
    return next((name for name, members in WIKI_GROUPS.items() if wiki in members), OTHER_GROUP)


def hour_start(ts: Column) -> Column:
    return F.date_trunc("HOUR", ts)


def hour_timestamp(date: Column, hour: Column) -> Column:
    """Start of the hour from the `date` and `hour` columns of a rollup."""
    return date.cast("timestamp") + F.make_dt_interval(hours=hour)


def micros(ts: Column) -> Column:
    """Integer microseconds since the epoch of a TIMESTAMP or UTC TIMESTAMP_NTZ column."""
    return F.unix_micros(ts.cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    """Exact epoch seconds with six decimals, in plain notation."""
    return ts.cast("timestamp").cast("decimal(20,6)")


def at(moment: dt.datetime | str) -> Column:
    """A UTC point in time as a literal: text, or a datetime (naive ones are UTC)."""
    if isinstance(moment, dt.datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
        moment = moment.isoformat(sep=" ")
    elif isinstance(moment, dt.date):
        moment = moment.isoformat()
    return F.lit(moment).cast("timestamp")


def seconds_between(earlier: Column, later: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(1_000_000.0)


def hours_before(t: Column, reference: Column) -> Column:
    """Signed offset in hours to a reference time; earlier points are negative."""
    return (micros(t) - micros(reference)) / F.lit(3_600_000_000.0)


def stable_bucket(text: Column, buckets: int) -> Column:
    """SHA-256 of the text, read as one big number, modulo `buckets`.

    Folded over eight 32-bit digits, so every step fits a BIGINT and no lambda is needed.
    """
    if not 0 < buckets <= 2**31:
        raise ValueError("number of buckets must be between 1 and 2**31")
    digest = F.sha2(text, 256)
    digit_weight = F.lit((2**32) % buckets)
    value = F.lit(0).cast("bigint")
    for position in range(8):
        digit = F.conv(F.substring(digest, 1 + 8 * position, 8), 16, 10).cast("bigint")
        value = (value * digit_weight + digit) % F.lit(buckets)
    return value


def series_label(wiki: Column, title: Column) -> Column:
    return F.concat_ws("/", wiki, title)


def bot_flags(bot: Column) -> list[Column]:
    """Per event: 1, 1 if made by a bot, 1 if not; NULL where it does not apply."""
    return [
        F.lit(1).alias("count_bot_flagignore"),
        F.when(bot, F.lit(1)).alias("count_bot_true"),
        F.when(~bot, F.lit(1)).alias("count_bot_false"),
    ]


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)
