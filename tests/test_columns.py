import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from changetide.functions import columns as C


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


def test_content_key_treats_missing_as_empty(spark):
    df = spark.createDataFrame(
        [("a", "b", 5, "u"), (None, None, None, None)], "i string, d string, n bigint, u string"
    )
    keys = [r[0] for r in df.select(C.content_key(*[F.col(c) for c in "idnu"])).collect()]
    expected = [hashlib.md5(t.encode()).hexdigest() for t in ("a_-b_-5_-u_", "_-_-_-_")]
    assert keys == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-12-13T18:10:00.123Z", dt.datetime(2025, 12, 13, 18, 10, 0, 123000)),
        ("2025-12-13T18:10:00Z", dt.datetime(2025, 12, 13, 18, 10)),
        ("2025-12-13T18:10:00.123456Z", dt.datetime(2025, 12, 13, 18, 10, 0, 123000)),
        ("2025-12-13T00:30:00+01:00", dt.datetime(2025, 12, 12, 23, 30)),
        ("12:30:00", None),
        ("not a time", None),
        ("2025-13-01T00:00:00Z", None),
        (None, None),
    ],
)
def test_event_time(spark, text, expected):
    assert one(spark, lambda v: C.event_time(v).cast("timestamp_ntz"), text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-12-13T00:30:00+01:00", dt.date(2025, 12, 13)),
        ("2025-12-13 garbage", dt.date(2025, 12, 13)),
        ("2025-99-13T", None),
        ("garbage", None),
        (None, None),
    ],
)
def test_key_date_is_bounded_by_the_calendar(spark, text, expected):
    assert one(spark, C.key_date, text) == expected


@pytest.mark.parametrize("buckets", [1, 7, 10, 24, 2**31])
def test_stable_bucket_equals_big_integer_modulo(spark, buckets):
    names = ["enwiki", "dewiki", "", "other wikis", "ä", "wikidatawiki"]
    df = spark.createDataFrame([(n,) for n in names], "v string")
    got = {r[0]: r[1] for r in df.select("v", C.stable_bucket(F.col("v"), buckets)).collect()}
    assert got == {n: int(hashlib.sha256(n.encode()).hexdigest(), 16) % buckets for n in names}


def test_stable_bucket_checks_the_number_of_buckets():
    with pytest.raises(ValueError):
        C.stable_bucket(None, 0)


@pytest.mark.parametrize(
    "wiki, group",
    [
        ("dewiki", "dewiki"),
        ("enwiki", "enwiki"),
        ("commonswiki", "hightraffic"),
        ("wikidatawiki", "hightraffic"),
        ("frwiki", "otherwikis"),
    ],
)
def test_wiki_group(spark, wiki, group):
    assert one(spark, C.wiki_group, wiki) == group == C.wiki_group_of(wiki)


def test_missing_wiki_is_in_the_other_group(spark):
    assert one(spark, C.wiki_group, None) == "otherwikis"


def test_hours_before_is_negative_for_earlier_points(spark):
    df = spark.sql("SELECT TIMESTAMP'2025-01-01 10:30:00' t, TIMESTAMP'2025-01-01 12:00:00' r")
    assert df.select(C.hours_before(F.col("t"), F.col("r"))).first()[0] == -1.5


def test_bot_flags(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    rows = [tuple(r) for r in df.select(*C.bot_flags(F.col("b"))).collect()]
    assert rows == [(1, 1, None), (1, None, 1), (1, None, None)]


def test_hour_timestamp(spark):
    df = spark.sql("SELECT DATE'2025-01-01' d, 13 h")
    t = C.hour_timestamp(F.col("d"), F.col("h")).cast("timestamp_ntz")
    assert df.select(t).first()[0] == dt.datetime(2025, 1, 1, 13)


def test_epoch_seconds_are_plain_decimals(spark):
    df = spark.sql("SELECT TIMESTAMP'2025-11-06 20:11:07.155' t")
    assert str(df.select(C.epoch_seconds(F.col("t"))).first()[0]) == "1762459867.155000"
