import datetime as dt

import pytest
from pyspark.sql import functions as F

from changetide import mapping
from changetide.operators.registry import load_fact, record_facts, registry_state, timestamp_fact
from changetide.operators.rollups import hourly_counts
from changetide.operators.staging import (
    add_content_key,
    batch_ranges,
    dedup_changes,
    parse_changes,
    possible_matches,
    unseen_changes,
)
from changetide.plans.load import checked_files, load_batch
from changetide.schema import EVENT_COLUMNS
from changetide.sources import dumps
from changetide.sources.tables import (
    append_changes,
    ensure_table,
    read_changes,
    read_registry,
    read_rollup,
    read_table,
    with_partitions,
)
from conftest import change, rows_of

A = "stream_20251213T180500_000001.gz.ready"
B = "stream_20251213T190500_000002.gz.ready"

EDGE_LINES = [
    "{bad",
    "",
    "[]",
    "5",
    '{"id":1}',
    '{"meta":null}',
    '{"meta":{}}',
    change(1, domain="canary"),
    {"meta": {"dt": "2025-12-13T18:10:00Z", "id": "nodomain"}, "id": 2},
    change(3),
    change(3),
    change(4, title="X"),
    change(4, title="A"),
    change(5, bot="x"),
    change(6, id=2**63),
    change(7, id=1.5),
    change(8, dt="2025-12-13T18:10:00Z"),
    change(9, dt="2025-12-13T00:10:00+01:00"),
    change(10, dt="not a time"),
    change(11, bot=None, title=None, wiki=None, user=None),
]


def test_edge_lines(spark, write_dump, tmp_path):
    path = write_dump(A, EDGE_LINES)
    staged = parse_changes(dumps.read_dumps(spark, path))
    assert staged.count() == 14
    kept = {r["event_meta_id"]: r for r in dedup_changes(add_content_key(staged)).collect()}
    assert set(kept) == {"m3", "m4", "m5", "m6", "m7", "m8", "m9", "m10", "m11"}
    assert kept["m4"]["event_title"] == "A"
    assert kept["m5"]["event_bot"] is None and kept["m5"]["corrupt_text"]
    assert kept["m6"]["event_id"] is None and kept["m6"]["corrupt_text"]
    assert kept["m7"]["event_id"] is None and kept["m7"]["event_title"] == "T"
    assert kept["m3"]["corrupt_text"] is None
    assert str(kept["m9"]["ts_event_meta_dt"]) == "2025-12-12 23:10:00"
    assert kept["m10"]["ts_event_meta_dt"] is None
    assert kept["m11"]["event_wiki"] is None and kept["m11"]["event_bot"] is None


def test_load_counts_and_idempotence(spark, write_dump, tmp_path):
    a = write_dump(A, EDGE_LINES)
    b = write_dump(B, [change(3), change(20), change(20), "{bad"])
    write_dump("stream_20251213T200500_000003.gz.ready", [])
    target = str(tmp_path / "table")
    stats = load_batch(spark, str(tmp_path / "dumps"), target)
    counts = ["filename", "lines", "undecodable", "staged", "ill_typed", "deduplicated", "merged"]
    assert rows_of(stats, *counts) == [
        (A, 20, 2, 14, 3, 9, 9),
        (B, 4, 1, 3, 0, 2, 1),
        ("stream_20251213T200500_000003.gz.ready", 0, 0, 0, 0, 0, 0),
    ]
    once = rows_of(read_changes(spark, target))
    assert len(once) == 10
    again = load_batch(spark, [a, b], target)
    assert rows_of(again, "filename", "deduplicated", "merged") == [(A, 9, 0), (B, 2, 0)]
    assert rows_of(read_changes(spark, target)) == once


def test_load_order_does_not_change_the_keys(spark, write_dump, tmp_path):
    a, b = write_dump(A, EDGE_LINES), write_dump(B, [change(3), change(4, title="0"), change(20)])
    keys = []
    for order in ([a, b], [b, a]):
        target = str(tmp_path / f"t{len(keys)}")
        for file in order:
            load_batch(spark, file, target)
        keys.append(rows_of(read_changes(spark, target), "_h"))
    assert keys[0] == keys[1]


def test_interrupted_load_run_again_under_its_id(spark, write_dump, tmp_path):
    """Part of the files of a load reached the table: the second run adds and counts the rest."""
    a = write_dump(A, [change(i) for i in range(6)])
    target = str(tmp_path / "table")
    ensure_table(spark, target)
    batch = dedup_changes(add_content_key(parse_changes(dumps.read_dumps(spark, a))))
    part = batch.where("event_id < 2").withColumns({"load_id": F.lit("L"), "load_file": F.lit(A)})
    append_changes(part, target)
    stats = load_batch(spark, a, target, load_id="L").first()
    assert stats["merged"] == 6 and read_changes(spark, target).count() == 6


def test_registry(spark, write_dump, tmp_path):
    a = write_dump(A, [change(1), change(2), "{bad"])
    target, registry = str(tmp_path / "table"), str(tmp_path / "registry")
    load_batch(spark, a, target, registry)
    names = spark.createDataFrame([(A,)], "filename string")
    record_facts(timestamp_fact(names, "archived", dt.datetime(2026, 1, 1)), registry)
    state = registry_state(read_registry(spark, registry)).first()
    assert (state["filename"], state["loadstat_events_in_file"], state["loadstat_events_merged"]) == (A, 3, 2)
    assert state["ts_load_begin"] <= state["ts_load_end"] and str(state["ts_file_archive"]) == "2026-01-01 00:00:00"
    assert state["ts_file_transfer"] is None
    load_batch(spark, a, target, registry)
    assert registry_state(read_registry(spark, registry)).first()["loadstat_events_merged"] == 0


def test_load_keeps_the_rollups_up_to_date(spark, write_dump, tmp_path):
    target, rollups = str(tmp_path / "table"), str(tmp_path / "rollups")
    hours = [f"2025-12-13T{h:02d}:30:00Z" for h in range(24)] + ["2025-12-14T00:10:00Z", "2025-12-12T05:00:00Z"]
    for i in range(3):
        part = [change(100 * i + k, dt=t) for k, t in enumerate(hours[i * 10 : i * 10 + 10])]
        load_batch(spark, write_dump(f"stream_20251213T18050{i}_000001.gz.ready", part), target, rollups=rollups)
        for edits_only in (False, True):
            stored = read_rollup(spark, rollups, edits_only)
            expected = hourly_counts(read_changes(spark, target), edits_only)
            assert rows_of(stored, *expected.columns) == rows_of(expected)
    assert read_rollup(spark, rollups).count() == 25


def test_unknown_time_stamp_kind(spark):
    with pytest.raises(ValueError):
        timestamp_fact(spark.createDataFrame([("a",)], "filename string"), "loaded", dt.datetime.now())


def test_load_fact_counts(spark):
    stats = spark.createDataFrame([("a", 5, 4)], "filename string, lines bigint, merged bigint")
    assert rows_of(load_fact(stats, dt.datetime(2026, 1, 1)), "fact", "events_in_file", "events_merged") == [
        ("load_complete", 5, 4)
    ]


def test_file_list_argument():
    assert checked_files("a") == ["a"] and checked_files(["a", "b"]) == ["a", "b"]
    assert checked_files([]) == []
    for wrong in (None, 5, {"a": 1}, ["a", 5]):
        with pytest.raises(ValueError):
            checked_files(wrong)


def test_load_needs_utc(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError):
            load_batch(spark, "x", str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def keyed(spark, events):
    import json

    lines = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    return add_content_key(parse_changes(lines)).select(*EVENT_COLUMNS)


@pytest.mark.parametrize("days", [1, 100])
def test_pruned_merge_equals_whole_anti_join(spark, tmp_path, days):
    stamps = [f"{2020 + i % 3}-{1 + i % 12:02d}-{1 + i % 28:02d}T{i % 24:02d}:00:00Z" for i in range(400)]
    events = [change(i, dt=stamps[i % days]) for i in range(400)]
    odd = [change(1000 + i, dt=t) for i, t in enumerate(["garbage", "2020-01-01 odd", None, "9"])]
    table = with_partitions(keyed(spark, events[:300] + odd[:3]))
    batch = with_partitions(keyed(spark, events[200:] + odd))
    ranges = batch_ranges(batch).collect()
    expected = rows_of(batch.join(table.select("_h"), "_h", "left_anti"), "_h")
    assert rows_of(unseen_changes(batch, table, ranges), "_h") == expected
    assert len(expected) == 101


def test_merge_reads_only_the_days_of_the_batch(spark, tmp_path):
    target = str(tmp_path / "table")
    append_changes(keyed(spark, [change(i, dt=f"2025-12-{1 + i:02d}T00:00:00Z") for i in range(20)]), target)
    batch = with_partitions(keyed(spark, [change(3, dt="2025-12-04T00:00:00Z")]))
    known = possible_matches(read_table(spark, target), batch_ranges(batch).collect())
    plan = known.select("_h")._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0] and "PushedFilters: [" in plan
    assert known.count() == 1
    keys = known.select("_h")
    keys.collect()
    scan = keys._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numFiles").get().value() == 1


def test_loading_nothing(spark, tmp_path):
    assert load_batch(spark, [], str(tmp_path / "table")).count() == 0
    assert read_changes(spark, str(tmp_path / "table")).count() == 0


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    row = keyed(spark, [change(1)])
    hot = row.crossJoin(spark.range(10_000).select()).unionByName(keyed(spark, [change(2)]))
    kept = dedup_changes(hot)
    assert kept.count() == 2
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_derived_event_table_equals_deduplicated_events(spark):
    folder = "/root/testdata/sf0.001"
    expected = dedup_changes(mapping.keyed(spark, folder))
    table = mapping.event_table(spark, folder)
    assert expected.count() == 980
    assert rows_of(table, *EVENT_COLUMNS) == rows_of(expected, *EVENT_COLUMNS)


@pytest.mark.parametrize("order", [(A, B), (B, A)])
def test_one_batch_is_the_files_in_turn(spark, write_dump, tmp_path, order):
    """Keys that are a test event in one file, or in the same one, and real elsewhere."""
    test = lambda n: change(n, domain="canary")
    lines = {A: [test(1), change(2), test(3), change(3)], B: [change(1), change(2), test(2), test(4)]}
    paths = {name: write_dump(name, lines[name]) for name in lines}
    batch, turn = str(tmp_path / "batch"), str(tmp_path / "turn")
    stats = rows_of(load_batch(spark, list(paths.values()), batch), "filename", "deduplicated", "merged")
    for name in order:
        load_batch(spark, paths[name], turn)
    ids = rows_of(read_changes(spark, batch), "event_meta_id")
    assert ids == rows_of(read_changes(spark, turn), "event_meta_id") == [("m1",), ("m2",), ("m3",)]
    assert stats == [(A, 2, 2), (B, 2, 1)]


@pytest.mark.parametrize("days", [1, 100])
def test_merge_prunes_alike_for_few_and_many_days(spark, days):
    stamps = [(dt.date(2024, 1, 1) + dt.timedelta(days=2 * i)).isoformat() for i in range(days)]
    table = with_partitions(keyed(spark, [change(i, dt=f"{s}T01:00:00Z") for i, s in enumerate(stamps)]))
    ranges = batch_ranges(table).collect()
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        condition = possible_matches(table, ranges)._jdf.queryExecution().analyzed().expressions().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    assert condition.count("event_meta_dt") >= 2 * days and "event_date" in condition
    far = with_partitions(keyed(spark, [change(9, dt="1970-01-01T00:00:00Z"), change(8, dt="2024-01-02T01:00:00Z")]))
    assert possible_matches(far, ranges).count() == 0
