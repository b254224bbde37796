"""Schemas and fixed values of the event model."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the event table, in table order.
EVENT_COLUMNS = [
    "_h",
    "ts_event_meta_dt",
    "event_meta_dt",
    "event_meta_id",
    "event_meta_domain",
    "event_id",
    "event_type",
    "event_wiki",
    "event_user",
    "event_bot",
    "event_title",
]

# Staged columns: what is taken from the JSON text.
STAGED_COLUMNS = EVENT_COLUMNS[2:]

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("_h", T.StringType()),
        T.StructField("ts_event_meta_dt", T.TimestampType()),
        T.StructField("event_meta_dt", T.StringType()),
        T.StructField("event_meta_id", T.StringType()),
        T.StructField("event_meta_domain", T.StringType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_wiki", T.StringType()),
        T.StructField("event_user", T.StringType()),
        T.StructField("event_bot", T.BooleanType()),
        T.StructField("event_title", T.StringType()),
    ]
)

# The stored table adds the load (for exact, replay-safe merge counts) and the partition columns.
PROVENANCE_COLUMNS = ["load_id", "load_file"]
PARTITION_COLUMNS = ["event_date", "wiki_group"]
TABLE_SCHEMA = T.StructType(
    EVENT_SCHEMA.fields
    + [
        T.StructField("load_id", T.StringType()),
        T.StructField("load_file", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("wiki_group", T.StringType()),
    ]
)

ROLLUP_SCHEMA = T.StructType(
    [
        T.StructField("hour", T.IntegerType()),
        T.StructField("event_wiki", T.StringType()),
        T.StructField("count_bot_flagignore", T.LongType()),
        T.StructField("count_bot_true", T.LongType()),
        T.StructField("count_bot_false", T.LongType()),
        T.StructField("rollup", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("fact", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("events_in_file", T.LongType()),
        T.StructField("events_merged", T.LongType()),
    ]
)

# `id` and `bot` are read as text and cast afterwards: an ill-typed value then costs only its own
# field, and can be told from a missing one.
LINE_SCHEMA = (
    "array<struct<type:string,title:string,wiki:string,user:string,bot:string,id:string,"
    "meta:struct<dt:string,id:string,domain:string>>>"
)

# The wiki groups the event table is split by.
WIKI_GROUPS = {
    "dewiki": ["dewiki"],
    "enwiki": ["enwiki"],
    "hightraffic": ["commonswiki", "wikidatawiki"],
}
OTHER_GROUP = "otherwikis"

# Titles left out of the top-page lists.
EXCLUDED_TITLE_PREFIXES = ["Talk:", "User:", "User talk:", "Wikipedia:", "Wikipedia talk:"]

CANARY_DOMAIN = "canary"
OTHER_LABEL = "other wikis"

# Dump names, rotation and limits.
DUMP_NAME_PATTERN = r"^stream_([0-9]{8}T[0-9]{6})_[0-9]+.gz.ready$"
DUMP_GLOB = "stream_*.gz.ready"
DUMP_TIME_FORMAT = "yyyyMMdd'T'HHmmss"
SLICE_START_MINUTE = 5
MAX_EVENTS_PER_SLICE = 500_000
DEFAULT_MAX_AGE_DAYS = 28
MIN_MAX_AGE_DAYS = 3
BURST_SECONDS = 900
HEALTH_MAX_AGE_SECONDS = 900
