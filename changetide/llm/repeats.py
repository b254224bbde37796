"""Removing repeated byte strings with a difference-cover sample, one bucket of hashed strings at a time.

A string of `match` bytes is a repeat if it also starts earlier (smaller id, or earlier in the text).
Texts lie in chunks of a few MiB that are written once; then

1. Cover sample. D is a difference cover modulo v: for any two positions some shift below v brings both
   onto D. So two equal strings of `match` bytes have, at one shift, equal windows of
   match - v + 1 bytes at sampled positions; only |D| of v positions are sampled. Hashes of a chunk's
   distinct windows are sorted, each bucket of their space alone, and windows found twice stay: a filter.
2. Strings. Only positions with such a window ahead can start a repeat. They go, by a hash of the whole
   string, to buckets, each sorted alone by hash, id and place; all but the first of equal strings
   are repeats.

No suffixes are sorted by their bytes, and the sample has no ranks: strings have one fixed length, so
whether two are equal is all that is asked, and a hash of 80 bits or more says it. Suffix order would
answer for every length.

A chunk sends a string once, so what all documents share costs a row per chunk, not per document.
Between chunks and buckets go packed arrays, and bits back; memory is bounded by a chunk or a bucket.
Exact copies of a text never enter: all of their strings start earlier.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from changetide.llm.common import map_arrow, ship, stored, text_or_empty

#: A difference set; every difference modulo 57 occurs among its elements.
PERIOD, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
CHUNK = 1_000_000
#: Sampled windows, or strings, of a bucket, about; strings of it that are sorted at once.
BUCKET, SORTED = 1 << 20, 1 << 18
_LAST = np.iinfo(np.int64).max


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


@cache
def letters(seed: int) -> np.ndarray:
    """A random value per byte, and one more."""
    return mixed(np.arange(1, 258, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


@lru_cache(maxsize=1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number and of its inverse, modulo 2^64. A worker keeps one pair, of 16 MB for a usual chunk;
    what tells the seeds apart are their letters."""
    base = int(letters(1)[256]) | 1
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up, out=up), np.cumprod(down, out=down)


class Windows:
    """Hashes of the windows of some bytes."""

    def __init__(self, data: np.ndarray, seed: int):
        up, self.down = powers((len(data) >> 16) + 1 << 16)
        values = letters(seed)[data]
        values *= up[: len(data)]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values, out=self.sums[1:])

    def __call__(self, at: np.ndarray, width: int) -> np.ndarray:
        return mixed((self.sums[at + width] - self.sums[at]) * self.down[at])


@dataclass
class Chunk:
    """Texts of a chunk, in order of their ids, and what is known of its positions."""

    data: np.ndarray
    ids: np.ndarray
    sizes: np.ndarray

    def __post_init__(self):
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def fitting(self, width: int) -> np.ndarray:
        """Whether a window starting at each position stays in its text."""
        change = np.zeros(len(self.data) + 1, np.int8)
        long = self.sizes >= width
        change[self.starts[long]] += 1
        change[self.ends[long] - width + 1] -= 1
        return np.cumsum(change[:-1], dtype=np.int8) > 0

    def sampled(self, match: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the cover whose window stays in its text, in order of their keys (the bucket's bits and 32
        more); the distinct keys, and where the positions of each begin."""
        width = match - PERIOD + 1
        rows = np.arange(0, len(self.data), PERIOD)[:, None] + np.array(COVER)
        at = rows.ravel()
        at = at[at < len(self.data)]
        at = at[self.fitting(width)[at]]
        keys = Windows(self.data, 1)(at, width) >> np.uint64(32 - bits)
        order = np.argsort(keys)
        keys = keys[order]
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        return at[order], keys[begins], begins

    def candidates(self, live: np.ndarray, match: int) -> np.ndarray:
        """Positions that have a live window within the shift, and a whole string ahead of them."""
        change = np.zeros(len(self.data) + 1, np.int32)
        live = np.sort(live)
        text = np.searchsorted(self.ends, live, side="right")
        np.add.at(change, np.maximum(self.starts[text], live - PERIOD + 1), 1)
        change[live + 1] -= 1
        return np.flatnonzero((np.cumsum(change[:-1], dtype=np.int32) > 0) & self.fitting(match))

    def strings(self, at: np.ndarray, match: int, bits: int) -> tuple[np.ndarray, ...]:
        """Candidates by bucket; keys of their strings, and 64 and eight bits after the bucket's; which are the
        first with their key in this chunk."""
        at, keys = by_bucket(at, Windows(self.data, 2)(at, match), bits)
        more = Windows(self.data, 3)(at, match)
        low = keys << np.uint64(bits) | more >> np.uint64(64 - bits)
        first = np.zeros(len(at), bool)
        first[np.unique(low, return_index=True)[1]] = True
        return at, keys, low, more.astype(np.uint8), first

    def removed(self, repeats: np.ndarray, match: int) -> np.ndarray:
        """Bytes that the strings starting at distinct positions cover."""
        change = np.zeros(len(self.data) + 1, np.int32)
        change[repeats] += 1
        change[repeats + match] -= 1
        return np.cumsum(change[:-1], dtype=np.int32) > 0


def by_bucket(at: np.ndarray, keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and keys in order of the keys' highest bits, else as they are."""
    order = np.argsort((keys >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint64), kind="stable")
    return at[order], keys[order]


def segments(keys: np.ndarray, shift: int) -> Iterator[tuple[int, int, int]]:
    """Bucket, start and end of the runs of keys that are equal but for their `shift` lowest bits."""
    if len(keys):
        buckets = (keys >> np.uint64(shift)).astype(np.int64)
        edges = np.flatnonzero(np.diff(buckets, prepend=-1))
        yield from zip(buckets[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(keys)], strict=True)


def packed(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpacked(data: bytes, size: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=size).astype(bool)


def bucket_bits(n: int, size: int) -> int:
    """Bits that tell apart enough buckets for n keys, at most about `size` a bucket."""
    return max(3, (n // size).bit_length())


def chunk_texts(texts: DataFrame, most: int) -> DataFrame:
    """Rows (id, text, rest) gathered into chunks: chunk, n_bytes, ids, sizes, data, rest.

    `ids` and `sizes` are packed numbers, `data` packed text, `n_bytes` its size before packing, `rest` the other
    columns as an Arrow table in the same order. A text is never split: a longer one than `most` is a chunk.
    """

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, size = TaskContext.get().partitionId() << 32, [], 0

        def emit() -> pa.RecordBatch:
            whole = pa.Table.from_batches(waiting)
            whole = whole.append_column("_order", whole.column("id").fill_null(_LAST)).sort_by("_order")
            data = [t.encode() for t in whole.column("text").to_pylist()]
            rest = whole.column("rest").combine_chunks().flatten() if whole.num_rows else []
            names = whole.schema.field("rest").type.names
            sink = pa.BufferOutputStream()
            rest = pa.Table.from_arrays(rest, names=names)
            with pa.ipc.new_stream(sink, rest.schema) as writer:
                writer.write_table(rest)
            ids = whole.column("_order").to_numpy().astype(np.int64).tobytes()
            sizes = np.array([len(d) for d in data], np.int64).tobytes()
            data = b"".join(data)
            row = [[number], [len(data)], [ids], [sizes], [pa.compress(data, "zstd", asbytes=True)], [sink.getvalue().to_pybytes()]]
            kinds = [pa.int64()] * 2 + [pa.binary()] * 4
            names = ["chunk", "n_bytes", "ids", "sizes", "data", "rest"]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            start = 0
            for row, text in enumerate(batch.column("text")):
                size += len(text.as_buffer())
                if size >= most:
                    waiting.append(batch.slice(start, row + 1 - start))
                    yield emit()
                    number, waiting, size, start = number + 1, [], 0, row + 1
            if start < batch.num_rows:
                waiting.append(batch.slice(start))
        if waiting:
            yield emit()

    return map_arrow(texts, gather, "chunk bigint, n_bytes bigint, ids binary, sizes binary, data binary, rest binary")


def chunk_of(row: dict) -> Chunk:
    ids, sizes = (np.frombuffer(row[n], np.int64) for n in ("ids", "sizes"))
    data = pa.decompress(row["data"], int(sizes.sum()), "zstd", asbytes=True) if sizes.sum() else b""
    return Chunk(np.frombuffer(data, np.uint8), ids, sizes)


def sample_blobs(chunks: DataFrame, match: int, bits: int) -> DataFrame:
    """Distinct sampled windows of each chunk by bucket: chunk, bucket, keys (the 32 bits after the bucket's, in
    order), twice (whether the chunk has them more than once)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                at, keys, begins = chunk_of(one).sampled(match, bits)
                low, twice = keys.astype(np.uint32), np.diff(np.append(begins, len(at))) > 1
                parts = list(segments(keys, 32))
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([one["chunk"]] * len(parts), pa.int64()),
                        "bucket": pa.array([b for b, _, _ in parts], pa.int64()),
                        "keys": pa.array([low[i:j].tobytes() for _, i, j in parts], pa.binary()),
                        "twice": pa.array([packed(twice[i:j]) for _, i, j in parts], pa.binary()),
                    }
                )

    return map_arrow(chunks.select("chunk", "ids", "sizes", "data"), work, "chunk bigint, bucket bigint, keys binary, twice binary")


def repeated_windows(blobs: pa.Table) -> pa.Table:
    """Which windows of a bucket are there twice, in one chunk or in several: kind 1."""
    keys = arrays_of(blobs.column("keys"), range(blobs.num_rows), np.uint32)
    twice = [unpacked(t, len(k)) for t, k in zip(blobs.column("twice").to_pylist(), keys, strict=True)]
    ordered = np.concatenate(keys)
    ordered.sort()
    live = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    return answer(blobs, 1, [t | is_among(k, live) for t, k in zip(twice, keys, strict=True)])


def is_among(keys: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(keys), bool)
    return ordered[np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)] == keys


def answer(blobs: pa.Table, kind: int, flags: list[np.ndarray]) -> pa.Table:
    """Chunk, bucket, kind, flags as bits, and how many of them are set."""
    kinds = pa.array([kind] * blobs.num_rows, pa.int32())
    bits = pa.array([packed(f) for f in flags], pa.binary())
    n_set = pa.array([int(f.sum()) for f in flags], pa.int64())
    return pa.table([blobs.column("chunk"), blobs.column("bucket"), kinds, bits, n_set], ["chunk", "bucket", "kind", "flags", "n_set"])


def flags_of(answers: pa.Table, kind: int) -> list[bytes]:
    """Flags of all buckets of a chunk, in order, as packed pieces that end on whole bytes."""
    rows = sorted((r["bucket"], r["flags"]) for r in answers.to_pylist() if r["kind"] == kind)
    return [f for _, f in rows]


def joined_flags(pieces: list[bytes], keys: np.ndarray, shift: int) -> np.ndarray:
    """One flag per key from the pieces of its buckets."""
    parts = [unpacked(piece, j - i) for piece, (_, i, j) in zip(pieces, segments(keys, shift), strict=True)]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def find_candidates(chunk: Chunk, answers: pa.Table, match: int, bits: int) -> np.ndarray:
    at, keys, begins = chunk.sampled(match, bits)
    live = joined_flags(flags_of(answers, 1), keys, 32)
    return chunk.candidates(at[np.repeat(live, np.diff(np.append(begins, len(at))))], match)


def string_blobs(match: int, sample_bits: int, bits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For a chunk and its sample's answers: its distinct candidate strings by bucket, in order of their texts' ids.

    Keys have 64 bits after the bucket's and eight more: 80 bits with 256 buckets, which a GB may need.
    """

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        columns: dict[str, list] = {n: [] for n in ("chunk", "bucket", "keys", "checks", "owners")}
        for one in left.to_pylist():
            chunk = chunk_of(one)
            at = find_candidates(chunk, right, match, sample_bits)
            if len(at):
                at, keys, low, checks, first = chunk.strings(at, match, bits)
                at, keys, low, checks = at[first], keys[first], low[first], checks[first]
                owners = chunk.ids[np.searchsorted(chunk.ends, at, side="right")]
                for bucket, i, j in segments(keys, 64 - bits):
                    values = (one["chunk"], bucket, low[i:j].tobytes(), checks[i:j].tobytes(), owner_bytes(owners[i:j]))
                    for name, value in zip(columns, values, strict=True):
                        columns[name].append(value)
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 3]
        return pa.table([pa.array(c, k) for c, k in zip(columns.values(), kinds, strict=True)], list(columns))

    return work


def owner_bytes(owners: np.ndarray) -> bytes:
    """Ids as runs: id and length of each."""
    edges = np.flatnonzero(np.diff(owners)) + 1
    starts = np.concatenate(([0], edges))
    return np.stack([owners[starts], np.diff(np.append(starts, len(owners)))]).tobytes()


def arrays_of(column: pa.ChunkedArray, rows: Iterable[int], kind: type) -> list[np.ndarray]:
    """Packed numbers of some rows, in that order, where Arrow has them."""
    return [np.frombuffer(column[row].as_buffer(), kind) for row in rows]


def sort_bucket(blobs: pa.Table, most: int = SORTED) -> pa.Table:
    """Sort the strings of a bucket by their hashes; all but the first of equal ones are repeats: kind 2.

    In a chunk strings come in order, so of equal ids the earlier chunk's, then the earlier one, is first. Strings are
    taken apart by the highest bits of their hashes and sorted about `most` at a time, so that only their hashes and
    flags, and runs of owners, are there of a whole bucket.
    """
    rows = np.argsort(blobs.column("chunk").to_numpy(), kind="stable").tolist()
    keys = np.concatenate(found := arrays_of(blobs.column("keys"), rows, np.uint64))
    ends = np.cumsum([len(k) for k in found])
    del found
    checks = np.concatenate(arrays_of(blobs.column("checks"), rows, np.uint8))
    runs = [o.reshape(2, -1) for o in arrays_of(blobs.column("owners"), rows, np.int64)]
    owners, until = np.concatenate([o[0] for o in runs]), np.cumsum(np.concatenate([o[1] for o in runs]))
    repeat = np.ones(len(keys), bool)
    high = keys.view(np.uint8)[7::8] if sys.byteorder == "little" else keys.view(np.uint8)[::8]
    bits = min(8, (len(keys) // most).bit_length())
    part = high >> (8 - bits) if bits else np.zeros(len(keys), np.uint8)
    for number in range(1 << bits):
        at = np.flatnonzero(part == number)
        if len(at):
            repeat[at[first_ones(keys[at], checks[at], owners[np.searchsorted(until, at, side="right")])]] = False
    flags = np.split(repeat, ends[:-1])
    return answer(blobs.select(["chunk", "bucket"]).take(rows), 2, flags)


def first_ones(keys: np.ndarray, checks: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Of the strings that have equal keys and checks, the first of the smallest owner."""
    order = np.argsort(keys, kind="stable")
    ordered, checked = keys[order], checks[order]
    new_key = np.append(True, ordered[1:] != ordered[:-1])
    new = new_key | np.append(True, checked[1:] != checked[:-1])
    if (new & ~new_key).any():  # different strings under one key
        order = np.lexsort((checks, keys))
        ordered, checked = keys[order], checks[order]
        new = np.append(True, (ordered[1:] != ordered[:-1]) | (checked[1:] != checked[:-1]))
    starts, owned = np.flatnonzero(new), owners[order]
    least = np.repeat(np.minimum.reduceat(owned, starts), np.diff(np.append(starts, len(owned))))
    group = np.cumsum(new, dtype=np.int32)
    smallest = np.flatnonzero(owned == least)
    return order[smallest[np.append(True, group[smallest[1:]] != group[smallest[:-1]])]]


def cut_chunk(match: int, sample_bits: int, bits: int, text: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For a chunk and all answers: the other columns, n_bytes, n_removed, n_spans, kept."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        results = []
        for one in left.to_pylist():
            chunk = chunk_of(one)
            repeats = np.zeros(0, np.int64)
            at = find_candidates(chunk, right, match, sample_bits)
            if len(at):
                at, keys, _, _, first = chunk.strings(at, match, bits)
                again = ~first
                again[first] = joined_flags(flags_of(right, 2), keys[first], 64 - bits)
                repeats = at[again]
            removed = chunk.removed(repeats, match)
            kept = (chunk.data[i:j][~removed[i:j]].tobytes() for i, j in zip(chunk.starts, chunk.ends, strict=True))
            total = np.concatenate(([0], np.cumsum(removed)))
            begins = removed & ~np.concatenate(([False], removed[:-1]))
            begins[chunk.starts[chunk.sizes > 0]] = removed[chunk.starts[chunk.sizes > 0]]  # a run ends with its text
            spans = np.concatenate(([0], np.cumsum(begins)))
            with pa.ipc.open_stream(one["rest"]) as stream:
                rest = stream.read_all()
            own = [pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if text else pa.array(kept, pa.binary())]
            numbers = (chunk.sizes, total[chunk.ends] - total[chunk.starts], spans[chunk.ends] - spans[chunk.starts])
            columns = [*rest.columns, *(pa.array(n.astype(np.int64)) for n in numbers), *own]
            results.append(pa.table(columns, [*rest.column_names, "_n_bytes", "_n_removed", "_n_spans", "_kept"]))
        return pa.concat_tables(results)

    return work


def remove_repeats(
    docs: DataFrame,
    match: int = 100,
    as_text: bool = False,
    chunk_bytes: int = CHUNK,
    bucket_size: int = BUCKET,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All rows of `docs` with its columns but the text, and `_n_bytes`, `_n_removed`, `_n_spans`, `_kept`.

    `_kept` are the bytes left of the text; with `as_text` a string, without characters that a cut
    left incomplete. A null text is empty. Ids are integers; a null id counts as later than all others;
    rows with equal ids come in a fixed order, one after the other. Texts shorter than `match` lose
    nothing. An empty table gives an empty one. Names beginning with an underscore are reserved.
    """
    if match < PERIOD + 16:
        raise ValueError(f"match has to be {PERIOD + 16} at least")
    spark = docs.sparkSession
    ship(spark)
    others = [c for c in docs.columns if c != text_column]
    named = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)).alias("id"),
        text_or_empty(text_column).alias("text"),
        F.struct(*others).alias("rest"),
    ).withColumn("key", F.md5("text"))
    # Stored, so that a text with very many copies is a skewed join that Spark splits.
    firsts, _ = stored(named.groupBy("key").agg(F.min("id").alias("first")), "firsts")
    placed = named.join(firsts, "key")
    chunks, _ = stored(chunk_texts(placed.where(F.col("id") == F.col("first")).select("id", "text", "rest"), chunk_bytes), "chunks")
    bits = bucket_bits((chunks.agg(F.sum("n_bytes")).first()[0] or 0) * len(COVER) // PERIOD, bucket_size)

    found = sample_blobs(chunks, match, bits).groupBy("bucket").applyInArrow(repeated_windows, ANSWER)
    found, _ = stored(found, "windows")
    # Along a repeat, |D| of v positions are sampled and all of them are candidates.
    more = bucket_bits((found.agg(F.sum("n_set")).first()[0] or 0) * PERIOD // len(COVER), bucket_size)
    by_chunk = chunks.groupBy("chunk")
    strings = by_chunk.cogroup(found.groupBy("chunk")).applyInArrow(
        string_blobs(match, bits, more), "chunk bigint, bucket bigint, keys binary, checks binary, owners binary"
    )
    repeats, _ = stored(strings.groupBy("bucket").applyInArrow(lambda blobs: sort_bucket(blobs), ANSWER), "repeats")
    rest_schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    kind = "string" if as_text else "binary"
    cut = by_chunk.cogroup(found.unionByName(repeats).groupBy("chunk")).applyInArrow(
        cut_chunk(match, bits, more, as_text), f"{rest_schema}, _n_bytes bigint, _n_removed bigint, _n_spans bigint, _kept {kind}"
    )
    copies = placed.where(F.col("id") != F.col("first")).withColumn("_n_bytes", F.octet_length("text").cast("long"))
    gone = F.col("_n_bytes") >= match
    copies = copies.select(
        *(F.col("rest")[c].alias(c) for c in others),
        "_n_bytes",
        F.when(gone, F.col("_n_bytes")).otherwise(0).alias("_n_removed"),
        gone.cast("long").alias("_n_spans"),
        F.when(gone, F.lit("")).otherwise(F.col("text")).cast(kind).alias("_kept"),
    )
    return cut.unionByName(copies)


ANSWER = "chunk bigint, bucket bigint, kind int, flags binary, n_set bigint"


def repeat_spans(docs: DataFrame, match: int = 100, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256; see `remove_repeats`."""
    only = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return remove_repeats(only, match, id_column="id", text_column="text").select(
        F.col("id").alias(id_column),
        F.col("_n_bytes").alias("n_bytes"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def cut_documents(docs: DataFrame, match: int = 100, id_column: str = "doc_id", text_column: str = "text", size_column: str = "n_chars") -> DataFrame:
    """The rows of `docs` with what is left of their texts; a column with their length is kept right."""
    cut = remove_repeats(docs, match, as_text=True, id_column=id_column, text_column=text_column)
    cut = cut.withColumnRenamed("_kept", text_column)
    if size_column in docs.columns:
        cut = cut.withColumn(size_column, F.length(text_column).cast(docs.schema[size_column].dataType))
    return cut.select(*docs.columns)
