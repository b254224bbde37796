import datetime as dt

import pytest
from pyspark.sql import functions as F

from changetide import mapping
from changetide.operators import slices, status
from conftest import rows_of
from test_rollups import FOLDER, events


@pytest.mark.parametrize(
    "as_of, expected",
    [
        ("2025-01-01 10:00:01", "OK"),
        ("2025-01-01 10:00:05", "OK"),
        ("2025-01-01 10:00:05.000001", "ERROR"),
        ("2025-01-01 10:00:11", "ERROR"),
    ],
)
def test_health(spark, as_of, expected):
    df = events(spark, [(f"2025-01-01 {t}", "a", "edit", True) for t in ("10:00:00", "09:00:00")])
    assert status.health_status(df, as_of, 5).first()["status"] == expected


def test_health_without_events(spark):
    row = status.health_status(events(spark, []), "2025-01-01 10:00:00").first()
    assert tuple(row) == (None, None, "ERROR")


def test_newest_event_in_local_time(spark):
    df = events(spark, [("2025-11-10 11:04:59.855", "a", "edit", True)])
    row = status.newest_event(df, "Europe/Berlin").first()
    assert row["max_ts_local"] == "2025-11-10T12:04:59.855000+01:00"
    assert status.newest_event(df, "America/St_Johns").first()["max_ts_local"] == "2025-11-10T07:34:59.855000-03:30"
    whole = events(spark, [("2025-11-10 11:04:59", "a", "edit", True)])
    assert status.newest_event(whole, "UTC").first()["max_ts_local"] == "2025-11-10T11:04:59+00:00"


def test_db_stats_agrees_with_its_parts(spark):
    changes = mapping.event_table(spark, FOLDER)
    as_of = dt.datetime(2024, 1, 31)
    row = status.db_stats(changes, as_of).first()
    assert row["min_ts"] == status.oldest_event(changes).first()[0]
    assert row["max_ts"] == status.newest_event(changes).first()[0]
    assert row["freshness_sec"] == status.freshness_age(changes, as_of).first()[0]
    assert row["nevents"] == status.event_count(changes).first()[0] == 980


def test_duplicate_ids(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "event_meta_id string")
    assert rows_of(status.duplicate_meta_ids(df)) == [("a", 2), (None, 2)]


def test_slices_start_at_five_past(spark):
    df = events(
        spark, [(f"2025-01-01 {t}", "a", "edit", True) for t in ("10:04:59.999", "10:05:00", "11:04:59", "11:05:00")]
    )
    starts = [r[0] for r in slices.with_slice_start(df).orderBy("ts_event_meta_dt").select("slice_start").collect()]
    assert [str(s)[11:16] for s in starts] == ["09:05", "10:05", "10:05", "11:05"]


@pytest.mark.parametrize("limit", [1, 3, 500_000])
def test_slices_are_full_in_order_and_whole(spark, limit):
    df = spark.range(700).select(
        F.md5(F.col("id").cast("string")).alias("_h"),
        F.when(F.col("id") > 5, F.timestamp_micros((F.col("id") % 40) * 300_000_000)).alias("ts_event_meta_dt"),
    )
    cut = slices.dump_slices(df, limit)
    assert cut.count() == 700
    order = "slice_start, date_trunc('SECOND', ts_event_meta_dt), _h"
    expected = slices.with_slice_start(df).selectExpr(
        "_h", f"CAST((row_number() OVER (PARTITION BY slice_start ORDER BY {order}) - 1) DIV {limit} AS BIGINT)"
    )
    assert rows_of(cut, "_h", "slice_part") == rows_of(expected)


def test_slice_size_is_checked(spark):
    with pytest.raises(ValueError):
        slices.dump_slices(mapping.event_table(spark, FOLDER), 0)
