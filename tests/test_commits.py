import datetime as dt

import pytest
from pyspark.sql import functions as F

from changetide import mapping
from changetide.operators.rollups import both_hourly_counts, hourly_counts
from changetide.operators.staging import add_content_key, dedup_changes, parse_changes
from changetide.plans import load
from changetide.sources import commits, dumps, files
from changetide.sources.tables import append_changes, ensure_table, read_changes, read_table
from conftest import change, rows_of

NAMES = [f"stream_2025121{i}T180500_00000{i}.gz.ready" for i in range(1, 7)]


def part_of(day, start, n, **more):
    """Events of a day; every one of the others lies on a day before, as late ones do."""
    return [change(i, dt=f"2025-12-{day - 3 * (i % 2):02d}T{(5 * i) % 24:02d}:30:00Z", **more) for i in range(start, start + n)]


def assert_counts_are_fresh(spark, target):
    for edits_only in (False, True):
        expected = hourly_counts(read_changes(spark, target), edits_only)
        got = commits.committed_rollup(spark, target, edits_only)
        assert rows_of(got, *expected.columns) == rows_of(expected)


def test_loads_out_of_order_are_counted_once(spark, write_dump, tmp_path):
    target = str(tmp_path / "table")
    ensure_table(spark, target)
    assert_counts_are_fresh(spark, target)
    for k, day in enumerate([20, 11, 25]):
        lines = part_of(day, 100 * k, 9) + part_of(day, 100 * k, 4) + [change(900 + k, type="new"), change(950 + k, dt="odd"), change(1, wiki=None)]
        load.load_batch(spark, write_dump(NAMES[k], lines), target)
        assert_counts_are_fresh(spark, target)
    for _ in range(2):
        commits.fold_counts(spark, target)
    assert_counts_are_fresh(spark, target)
    # After two folds the counts of the loads are gone, and those of the last two folds are there.
    assert len([f for f in files.children(spark, f"{target}/_counts") if "attempt=" in f]) == 2
    load.load_batch(spark, write_dump(NAMES[5], part_of(14, 7000, 5)), target)
    commits.compact_commits(spark, target)
    assert_counts_are_fresh(spark, target)
    assert len([f for f in files.children(spark, f"{target}/_commits") if f.endswith(".parquet")]) == 1
    commits.fold_counts(spark, target, both_hourly_counts(read_changes(spark, target).where("ts_event_meta_dt IS NOT NULL")))
    assert_counts_are_fresh(spark, target)


@pytest.mark.parametrize("dies_at", ["merge_changes", "store_counts", "commit"])
def test_a_load_that_dies_is_not_seen(spark, write_dump, tmp_path, monkeypatch, dies_at):
    """It dies before or after a step; neither another load nor the same one run again is disturbed by what it left."""
    a, b = write_dump(NAMES[0], part_of(12, 0, 8)), write_dump(NAMES[1], part_of(12, 4, 8))
    target = str(tmp_path / "table")
    load.load_batch(spark, write_dump(NAMES[2], part_of(13, 500, 3)), target)
    before = rows_of(read_changes(spark, target))
    real = getattr(load, dies_at)

    def die(*args):
        if dies_at == "merge_changes":  # the events are written, nothing else
            real(*args)
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(load, dies_at, die)
        with pytest.raises(RuntimeError):
            load.load_batch(spark, a, target, load_id="A")
    assert read_table(spark, target).count() == 3 + 8
    assert rows_of(read_changes(spark, target)) == before
    assert_counts_are_fresh(spark, target)
    # Four keys of the dead load come by another one.
    assert load.load_batch(spark, b, target, load_id="B").first()["merged"] == 8
    assert load.load_batch(spark, a, target, load_id="A").first()["merged"] == 4
    assert rows_of(read_changes(spark, target).select("event_meta_id").distinct()) == rows_of(read_changes(spark, target), "event_meta_id")
    assert read_changes(spark, target).count() == 3 + 12
    assert_counts_are_fresh(spark, target)
    # A committed load is not run again, and tells what it merged.
    assert load.load_batch(spark, a, target, load_id="A").first()["merged"] == 4
    assert read_changes(spark, target).count() == 15


def test_rows_without_a_load_count_at_once(spark, tmp_path):
    target = str(tmp_path / "table")
    changes = mapping.event_table(spark, "/root/testdata/sf0.001")
    ensure_table(spark, target)
    append_changes(changes, target)
    assert read_changes(spark, target).count() == changes.count()
    # A table from before there were commits.
    old = str(tmp_path / "old")
    append_changes(changes.withColumns({"load_id": F.lit("x"), "load_file": F.lit("f")}), old)
    ensure_table(spark, old)
    assert read_changes(spark, old).count() == changes.count()


def test_commits_are_joined_small_and_filters_still_prune(spark, write_dump, tmp_path):
    target = str(tmp_path / "table")
    load.load_batch(spark, write_dump(NAMES[0], part_of(12, 0, 8)), target)
    found = read_changes(spark, target).where("event_date = DATE '2025-12-12'").select("_h")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "2025-12-12" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert found.count() == 4


def test_keys_of_a_load_are_free_of_repetitions(spark, write_dump, tmp_path):
    target = str(tmp_path / "table")
    path = write_dump(NAMES[0], part_of(12, 0, 8) * 3)
    load.load_batch(spark, path, target)
    want = dedup_changes(add_content_key(parse_changes(dumps.read_dumps(spark, path))))
    assert rows_of(read_changes(spark, target), "_h") == rows_of(want, "_h")
    assert attempt_rows(spark, target) == 1
    assert commits.read_commits(spark, target).first()["committed_at"] <= dt.datetime.now()


def attempt_rows(spark, target):
    return commits.read_commits(spark, target).count()
