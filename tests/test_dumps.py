import datetime as dt

import pytest
from pyspark.sql import functions as F

from changetide.operators.retention import expired_dumps, new_dumps, parse_dump_names, select_ready_dumps
from changetide.plans.load import dump_quality, first_event_time
from changetide.schema import REGISTRY_SCHEMA
from changetide.sources import dumps, epochs
from conftest import change, rows_of

GOOD = "stream_20251213T180500_000067.gz.ready"
BAD = [
    "stream_20251213T180500_000067.gz",
    "streamx_20251213T180500_000067.gz.ready",
    "xstream_20251213T180500_000067.gz.ready",
    "strea_20251213T180500_000067.gz.ready",
    "stream_20251213T180500_000067.gz.readyX",
    "stream_20251213T180500_000067.Xgz.ready",
    "stream_20251213T1805000_000067.gz.ready",
    "stream_20251213T18050_000067.gz.ready",
    "stream_202512130T180500_000067.gz.ready",
    "stream_2025121T180500_000067.gz.ready",
    "stream_20259913T180500_000067.gz.ready",
]


def named(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "filename string")


def test_dump_names(spark):
    parsed = {r["filename"]: r for r in parse_dump_names(named(spark, GOOD, *BAD)).collect()}
    assert parsed[GOOD]["is_valid_filename"] and str(parsed[GOOD]["ts"]) == "2025-12-13 18:05:00"
    assert not any(parsed[b]["is_valid_filename"] or parsed[b]["ts"] for b in BAD)
    assert [r["filename"] for r in select_ready_dumps(named(spark, GOOD, *BAD)).collect()] == [GOOD]


def test_expiry_is_strict(spark):
    now = dt.datetime(2026, 1, 10, 12, 0)

    def name(age):
        return "stream_" + (now - age).strftime("%Y%m%dT%H%M%S") + "_000067.gz.ready"

    limit, minute = dt.timedelta(days=14), dt.timedelta(minutes=1)
    names = [name(limit - minute), name(limit), name(limit + minute), name(limit * 2), *BAD]
    old = [r["filename"] for r in expired_dumps(named(spark, *names), now, 14).collect()]
    assert old == sorted([name(limit + minute), name(limit * 2)])


@pytest.mark.parametrize("days", [0, -1, 2])
def test_expiry_limit_is_checked(spark, days):
    with pytest.raises(ValueError):
        expired_dumps(named(spark, GOOD), "2026-01-01", days)


def test_new_dumps_are_those_not_loaded_completely(spark):
    at = dt.datetime(2026, 1, 1)
    facts = spark.createDataFrame(
        [("a", "load_complete", at, 1, 1), ("b", "load_begin", at, None, None)], REGISTRY_SCHEMA
    )
    assert rows_of(new_dumps(named(spark, "a", "b", "c"), facts)) == [("b",), ("c",)]


def test_read_dumps_keeps_every_line_and_its_place(spark, write_dump, tmp_path):
    lines = [f"line {i} ä" for i in range(50_001)] + ["", "last"]
    write_dump(GOOD, lines)
    write_dump("stream_20251213T190500_000068.gz", ["still being written"])
    write_dump("stream_20251213T200500_000069.gz.ready", ["plain text"], packed=False)
    got = dumps.read_dumps(spark, str(tmp_path / "dumps"))
    packed = got.where(F.col("path").endswith(GOOD)).orderBy("line_pos").collect()
    assert [r["value"] for r in packed] == lines
    assert [r["line_pos"]["seq"] for r in packed] == list(range(len(lines)))
    assert got.where(~F.col("path").endswith(GOOD)).select("value").collect() == [("plain text",)]


def test_line_reader_joins_lines_across_chunks():
    import gzip

    import pyarrow as pa

    text = b"ab\ncdefgh\n\nij" + b"k" * 50
    for content in (text, gzip.compress(text), gzip.compress(text[:7]) + gzip.compress(text[7:])):
        batch = pa.RecordBatch.from_pydict({"path": ["p"], "content": [content]})
        out = list(dumps._line_reader(chunk_bytes=4, lines_per_batch=2)([batch]))
        mark, *lines = [v for b in out for v in b.column("raw").to_pylist()]
        assert mark is None and lines == text.split(b"\n")
        assert [v["seq"] for b in out for v in b.column("line_pos").to_pylist()] == [-1, 0, 1, 2, 3]


def test_large_dumps_are_read_by_path(spark, write_dump, tmp_path):
    """Files above the limit give the same lines, and their content is never one value."""
    lines = [f"line {i} ä" for i in range(30_001)] + ["", "last"]
    write_dump(GOOD, lines)
    write_dump("stream_20251213T200500_000069.gz.ready", ["plain text", "of two lines"], packed=False)
    write_dump("stream 20%41 ä.gz.ready", ["odd name"])
    write_dump("empty.gz.ready", [], packed=False)
    folder = str(tmp_path / "dumps")
    want = rows_of(dumps.read_dumps(spark, folder, "*.ready").orderBy("path", "line_pos"))
    assert len(want) == len(lines) + 3
    for whole in (0, 100):
        assert rows_of(dumps.read_dumps(spark, folder, "*.ready", whole).orderBy("path", "line_pos")) == want
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")  # stands for the 2 GiB of a value
    try:
        with pytest.raises(Exception, match="exceeds|max length|maxLength"):
            dumps.read_dumps(spark, folder, "*.ready").count()
        assert rows_of(dumps.read_dumps(spark, folder, "*.ready", 100).orderBy("path", "line_pos")) == want
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_memory_of_a_large_dump_is_that_of_a_piece(tmp_path):
    import gzip
    import random
    import tracemalloc

    import pyarrow as pa

    noise = random.Random(1)
    file = tmp_path / "large.gz.ready"
    with gzip.open(file, "wb", compresslevel=1) as out:
        for _ in range(60):
            out.write(noise.randbytes(100_000).hex().encode() + b"\n" + b"x" * 99 + b"\n")
    assert file.stat().st_size > 5_000_000
    batch = pa.RecordBatch.from_pydict({"path": [f"file:{file}"]})
    reader = dumps._line_reader(chunk_bytes=1 << 16, lines_per_batch=10)
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    held = count = 0
    for part in reader([batch]):
        count += part.num_rows
        held = max(held, pa.total_allocated_bytes() - before)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == 121 and peak < 3_000_000 and held < 3_000_000


def test_text_dumps_agree_with_packed_ones(spark, write_dump, tmp_path):
    events = [change(i, dt=f"2025-12-13T18:{59 - i:02d}:00Z") for i in range(5)]
    write_dump("a.json", events, packed=False)
    write_dump("b.json.gz", events)
    lines = dumps.read_text_dumps(spark, str(tmp_path / "dumps"))
    assert lines.count() == 10
    first = first_event_time(lines)
    assert {str(r["first_ts"]) for r in first.collect()} == {"2025-12-13 18:59:00"}


def test_first_event_is_the_first_line_with_an_event(spark, write_dump, tmp_path):
    write_dump(GOOD, ["{bad", '{"id":1}', change(1, dt="2025-12-13T19:00:00Z"), change(2)])
    first = first_event_time(dumps.read_dumps(spark, str(tmp_path / "dumps"))).first()
    assert (first["filename"], str(first["first_ts"])) == (GOOD, "2025-12-13 19:00:00")


def test_dump_quality(spark, write_dump, tmp_path):
    bad = ["{bad", "", '{"a":1} trailing', "{'a': 1}", '{"a":1},{"a":2}', '{"a":"\t"}']
    good = ["5", "[]", "null", '"x"', '{"id":1}', '{"a":1,"a":2}', '{"x":NaN}', " {} "]
    write_dump(GOOD, bad + good)
    quality = dump_quality(dumps.read_dumps(spark, str(tmp_path / "dumps"))).first()
    assert tuple(quality) == (GOOD, len(bad) + len(good), len(bad))


def test_write_dumps_spreads_a_dump_and_keeps_order(spark, tmp_path):
    lines = spark.range(1000).select(F.lit("d").alias("dump"), F.col("id"), F.col("id").cast("string").alias("value"))
    out = str(tmp_path / "out")
    dumps.write_dumps(lines, out, order=("id",), max_lines=100)
    back = dumps.read_dumps(spark, out, "*.gz")
    assert back.select("path").distinct().count() >= 10
    assert [int(r["value"]) for r in back.orderBy("path", "line_pos").collect()] == list(range(1000))


def test_epochs_there_and_back(spark, tmp_path):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP'2025-11-06 20:11:07.155'), (NULL), (TIMESTAMP'1969-12-31 23:59:59.5')"
        " AS t(ts_event_meta_dt)"
    )
    out = str(tmp_path / "epochs")
    epochs.export_epochs(df, out)
    assert rows_of(spark.read.text(out)) == [("-0.500000",), ("1762459867.155000",)]
    assert rows_of(epochs.read_epochs(spark, out)) == [(-0.5,), (1762459867.155,)]
