"""Change events derived from the given `events` table: the same values in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from changetide.functions.columns import content_key
from changetide.operators.staging import add_content_key
from changetide.schema import EVENT_COLUMNS

SOURCE_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

# Texts of the derived columns; `g` spreads the users over the wikis at every scale.
_G = "((user_id * 61) % 150)"
_STAGED = {
    "event_meta_dt": """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")""",
    "event_meta_id": "concat('m-', CAST(event_id AS STRING))",
    "event_meta_domain": """CASE WHEN event_id % 97 = 0 THEN 'canary'
        WHEN event_id % 101 <> 0 THEN 'example.org' END""",
    "event_id": "CASE WHEN event_id % 13 <> 0 THEN event_id END",
    "event_type": """CASE event_type WHEN 'click' THEN 'edit' WHEN 'view' THEN 'edit'
        WHEN 'signup' THEN 'new' WHEN 'purchase' THEN 'log' ELSE 'categorize' END""",
    "event_wiki": f"""CASE WHEN event_id % 211 = 0 THEN NULL WHEN {_G} < 50 THEN 'wikidatawiki'
        WHEN {_G} < 80 THEN 'commonswiki' WHEN {_G} < 100 THEN 'enwiki' WHEN {_G} < 112 THEN 'dewiki'
        ELSE concat('w', CAST({_G} AS STRING), 'wiki') END""",
    "event_user": "CASE WHEN event_id % 59 <> 0 THEN concat('u', CAST(user_id AS STRING)) END",
    "event_bot": "CASE WHEN event_id % 17 <> 0 THEN user_id % 3 = 0 END",
    "event_title": """CASE WHEN event_id % 53 <> 0 THEN concat(
        CASE event_id % 11 WHEN 0 THEN 'Talk:' WHEN 1 THEN 'User:' WHEN 2 THEN 'User talk:'
            WHEN 3 THEN 'Wikipedia:' WHEN 4 THEN 'Wikipedia talk:' WHEN 5 THEN 'Template talk:' ELSE '' END,
        'Page ', regexp_extract(props, '([0-9]+)', 1)) END""",
}


def source_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMA).parquet(f"{folder}/events.parquet")


def with_repeats(events: DataFrame) -> DataFrame:
    """Each 40th event twice, as the stream sends some events again."""
    copies = "explode(sequence(1, CASE WHEN event_id % 40 = 0 THEN 2 ELSE 1 END)) AS _copy"
    return events.selectExpr("*", copies).drop("_copy")


def to_staged(events: DataFrame, *more: str) -> DataFrame:
    """The nine staged columns; wiki, type, title and gaps follow from the event's own values."""
    return events.selectExpr(*[f"{text} AS {name}" for name, text in _STAGED.items()], *more)


def keyed(spark: SparkSession, folder: str) -> DataFrame:
    """Staged events with repetitions and test events, with key and time."""
    return add_content_key(to_staged(with_repeats(source_events(spark, folder)))).select(*EVENT_COLUMNS)


def event_table(spark: SparkSession, folder: str) -> DataFrame:
    """The event table: every event once, without test events and events of unknown domain.

    Source events are unique, so nothing has to be de-duplicated and queries need no shuffle to
    get here (a test compares with `dedup_changes` of `keyed`). The time is that of the source,
    cut to milliseconds as the text is, which saves reading it back from the text.
    """
    known = source_events(spark, folder).where("event_id % 97 <> 0 AND event_id % 101 <> 0")
    staged = to_staged(known, "date_trunc('MILLISECOND', ts) AS ts_event_meta_dt")
    key = content_key(*[F.col(c) for c in ("event_meta_id", "event_meta_dt", "event_id", "event_user")])
    return staged.withColumn("_h", key).select(*EVENT_COLUMNS)


def json_lines(staged: DataFrame) -> DataFrame:
    """Staged events as lines of JSON, missing values left out."""
    value = """to_json(named_struct('type', event_type, 'title', event_title, 'wiki', event_wiki,
        'user', event_user, 'bot', event_bot, 'id', event_id, 'meta', named_struct(
        'dt', event_meta_dt, 'id', event_meta_id, 'domain', event_meta_domain)))"""
    return staged.withColumn("value", F.expr(value))
