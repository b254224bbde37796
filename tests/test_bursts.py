import random

import pytest
from pyspark.sql import functions as F

from changetide.operators import bursts
from changetide.sources.epochs import read_epochs
from conftest import rows_of

# Golden values of three small series: backward and forward counts.
SERIES = {
    "one": ([0, 1, 899, 900, 1000, 1001, 2000], [1, 2, 3, 4, 3, 4, 1], [4, 3, 4, 3, 2, 1, 1], 4),
    "two": ([0, 1, 899, 900, 1000, 2000], [1, 2, 3, 4, 3, 1], [4, 3, 3, 2, 1, 1], 4),
    "ties": (
        [0, 1, 899, 900, 900, 1000, 1001, 2000],
        [1, 2, 3, 5, 5, 4, 5, 1],
        [5, 4, 5, 4, 3, 2, 1, 1],
        5,
    ),
}


@pytest.mark.parametrize("name", SERIES)
def test_golden_series(spark, tmp_path, name):
    times, back, forth, peak = SERIES[name]
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "data.csv").write_text("".join(f"{t}\n" for t in reversed(times)))
    df = read_epochs(spark, str(folder))
    assert rows_of(bursts.burst_counts(df, "d")) == sorted(zip(map(float, times), back), key=repr)
    assert rows_of(bursts.burst_counts_forward(df, "d")) == sorted(zip(map(float, times), forth), key=repr)
    assert tuple(bursts.peak_burst(df, "d").first()) == (900.0, peak)
    assert tuple(bursts.peak_burst_forward(df, "d").first()) == (0.0, peak)


def brute(times, seconds):
    """Counts by looking at every pair; in microseconds."""
    span = seconds * 1_000_000
    back = sorted((t, sum(t - span <= x <= t for x in times)) for t in times)
    forth, seen = [], {}
    for t in sorted(times):
        forth.append((t, sum(t <= x <= t + span for x in times) - seen.get(t, 0)))
        seen[t] = seen.get(t, 0) + 1
    return back, sorted(forth)


def random_times(seed):
    rng = random.Random(seed)
    dense = [rng.randrange(-5_000_000, 40_000_000) for _ in range(250)]
    coarse = [1_000_000 * rng.randrange(0, 40) for _ in range(100)]
    return dense + coarse + dense[:30] + [7_000_000] * 50


@pytest.mark.parametrize("seconds", [1, 7, 20])
def test_against_brute_force(spark, seconds):
    times = random_times(seconds)
    back, forth = brute(times, seconds)
    df = spark.createDataFrame([(t,) for t in times], "u bigint").selectExpr("timestamp_micros(u) AS ts")
    got_back = bursts.burst_counts(df, "ts", seconds).selectExpr("unix_micros(window_end)", "c")
    got_forth = bursts.burst_counts_forward(df, "ts", seconds).selectExpr("unix_micros(window_start)", "c")
    assert sorted(tuple(r) for r in got_back.collect()) == back
    assert sorted(tuple(r) for r in got_forth.collect()) == forth
    end, c = min(back, key=lambda r: (-r[1], r[0]))
    peak = bursts.peak_burst(df, "ts", seconds).selectExpr("unix_micros(window_end)", "c").first()
    assert tuple(peak) == (end, c)
    start, c = min(forth, key=lambda r: (-r[1], r[0]))
    peak = bursts.peak_burst_forward(df, "ts", seconds).selectExpr("unix_micros(t0)", "len").first()
    assert tuple(peak) == (start, c)


def test_a_time_shared_by_very_many_events(spark):
    hot = spark.range(250_001).selectExpr("timestamp_seconds(100) AS ts")
    df = hot.unionByName(spark.sql("SELECT timestamp_seconds(150) AS ts"))
    counts = bursts.burst_counts(df, "ts", 60).groupBy("c").count()
    assert rows_of(counts) == [(250_001, 250_001), (250_002, 1)]
    forward = bursts.burst_counts_forward(df, "ts", 60).selectExpr("min(c)", "max(c)", "count(distinct c)", "count(*)")
    assert tuple(forward.first()) == (1, 250_002, 250_002, 250_002)


def test_no_events(spark):
    df = spark.sql("SELECT TIMESTAMP'2025-01-01' AS ts WHERE false")
    for operator in (bursts.burst_counts, bursts.burst_counts_forward, bursts.peak_burst, bursts.peak_burst_forward):
        assert operator(df, "ts").count() == 0


@pytest.mark.parametrize("seconds", [0, -1, 1.5])
def test_interval_is_checked(spark, seconds):
    with pytest.raises(ValueError):
        bursts.peak_burst(spark.sql("SELECT current_timestamp() AS ts"), "ts", seconds)


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_peak_from_merged_second_counts(spark, seed, forward):
    """Counts of three loads out of order; negative times, ties, nulls and a crowded second."""
    rng = random.Random(seed)
    times = [rng.choice([rng.uniform(-3000, 3000), float(rng.randint(-20, 20) * 50), 7.5]) for _ in range(90)] + [None]
    events = spark.createDataFrame([(t,) for t in times], "t double")
    loads = [spark.createDataFrame([(t,) for t in times[k::3]], "t double") for k in (2, 0, 1)]
    counts = bursts.merge_second_counts(*(bursts.second_counts(x, "t") for x in loads))
    whole = (bursts.peak_burst_forward if forward else bursts.peak_burst)(events, "t", 60)
    got = bursts.peak_from_seconds(counts, events, "t", 60, forward)
    assert got.columns == whole.columns and rows_of(got) == rows_of(whole) and got.count() == 1


@pytest.mark.parametrize("forward", [False, True])
def test_peak_reads_only_days_of_candidate_seconds(spark, tmp_path, forward):
    """A burst over midnight whose texts name the day before or after; other days are not scanned."""
    quiet = [(f"2025-01-{d:02d} 12:00:00", f"2025-01-{d:02d}") for d in range(1, 29)]
    burst = [("2025-01-14 23:59:50", "2025-01-15"), ("2025-01-15 00:00:10", "2025-01-14"), ("2025-01-15 00:01:00", None)]
    rows = spark.createDataFrame(quiet + burst, "t string, day string")
    events = rows.select(F.to_timestamp("t").alias("t"), F.to_date("day").alias("day"))
    events.write.partitionBy("day").parquet(str(tmp_path / "t"))
    table = spark.read.schema("t timestamp, day date").parquet(str(tmp_path / "t"))
    bursts.second_counts(table, "t").write.parquet(str(tmp_path / "counts"))
    counts = spark.read.parquet(str(tmp_path / "counts"))
    whole = rows_of((bursts.peak_burst_forward if forward else bursts.peak_burst)(table, "t", 120))
    for file in (tmp_path / "t" / "day=2025-01-20").glob("*.parquet"):
        file.write_bytes(b"cannot be read")
    table = spark.read.schema("t timestamp, day date").parquet(str(tmp_path / "t"))
    got = bursts.peak_from_seconds(counts, table, "t", 120, forward, day_column="day")
    assert rows_of(got) == whole and whole[0][1] == 3
    empty = table.limit(0)
    assert bursts.peak_from_seconds(bursts.second_counts(empty, "t"), empty, "t", 120, forward, "day").count() == 0
