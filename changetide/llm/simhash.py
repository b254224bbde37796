"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each a word of the perfect (23, 12)
Golay code's space (short ones padded with zeros). Of at most four differing bits, by pigeonhole,
either one segment is equal and another differs in at most two, or two segments differ in one bit each
and the third, z, in at most two. Of z cut into three parts, one is equal then. A word and a neighbour
at one bit: the code word nearest to the one is within four bits of the other. Words at two bits: the
code word nearest to the word between them is within four bits of both. So with `near` code words
(within four bits; six at most) as keys

* two segments (x, y) and a part of the third: one side has (nearest x, near y, part), the other
  (near x, nearest y, part): 31 or 32 bits;
* one equal segment x and another y: both sides have (x itself, near y): 33 or 34 bits

share a key for every pair that has to be found; each candidate's distance is then checked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations, permutations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from changetide.llm.common import map_arrow, slices, stored, text_or_empty
from changetide.llm.linking import linked_classes

#: Fixed values of the code: generator x^11+x^10+x^6+x^5+x^4+x^2+1, word length, check bits.
GENERATOR, LENGTH, CHECKS = 0xC75, 23, 11
#: First bit and width of each segment of a fingerprint.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: First bit and width of the parts of a third segment; the last of 22 bits is wider.
PARTS = ((0, 7), (7, 7), (14, 8))
MAX_BITS = 4
_AT_ONCE = 1 << 16


def remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


@cache
def code_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low and of the high bits of a word; error patterns by remainder.

    Each remainder has one pattern of up to three bits, first, and if that has three, five of four bits.
    Unused places repeat the first.
    """
    low = np.array([remainder(w) for w in range(1 << 12)], np.int64)
    high = np.array([remainder(w << 12) for w in range(1 << CHECKS)], np.int64)
    single = [remainder(1 << b) for b in range(LENGTH)]
    found: list[list[int]] = [[] for _ in range(1 << CHECKS)]
    for weight in range(MAX_BITS + 1):
        for bits in combinations(range(LENGTH), weight):
            rest = pattern = 0
            for b in bits:
                rest, pattern = rest ^ single[b], pattern | 1 << b
            found[rest].append(pattern)
    patterns = np.array([(f + f[:1] * 6)[:6] for f in found], np.int64)
    return low, high, patterns


def near_codewords(words: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the code words within four bits of each word, the nearest first: (n, 6)."""
    low, high, patterns = code_tables()
    rest = low[words & 0xFFF] ^ high[words >> 12]
    return (words[:, None] ^ patterns[rest]) >> CHECKS


def bucket_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position of the fingerprint, bucket, and side (1, 2, or 3 for both) of every key."""
    prints = fingerprints.view(np.uint64)
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    near = [near_codewords(p) for p in parts]
    more = [n[:, 1:] != n[:, :1] for n in near]  # places in use besides the first
    all_rows, rows, keys, sides = np.arange(len(prints)), [], [], []

    def add(row, key, side):
        rows.append(row)
        keys.append(key)
        sides.append(np.full(len(row), side, np.int8))

    number = 0
    for x, y, z in ((0, 1, 2), (0, 2, 1), (1, 2, 0)):
        row_y, place_y = np.nonzero(more[y])
        row_x, place_x = np.nonzero(more[x])
        both = near[x][:, 0] << 12 | near[y][:, 0]
        first = near[x][row_y, 0] << 12 | near[y][row_y, place_y + 1]
        second = near[x][row_x, place_x + 1] << 12 | near[y][row_x, 0]
        for at, width in PARTS:
            base, part = number << 40, (parts[z] >> at & (1 << width) - 1) << 24
            add(all_rows, base | part | both, 3)
            add(row_y, base | part[row_y] | first, 1)
            add(row_x, base | part[row_x] | second, 2)
            number += 1
    for x, y in permutations(range(3), 2):
        base = number << 40
        add(all_rows, base | parts[x] << 12 | near[y][:, 0], 3)
        row, place = np.nonzero(more[y])
        add(row, base | parts[x][row] << 12 | near[y][row, place + 1], 3)
        number += 1
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(sides)


def text_fingerprint(text: str, shingle: int) -> int:
    """64 majority bits over the XXH64 hashes (seed 42) of a text's word shingles; 0 without words."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n], ends[-n:]
    votes = np.zeros(64, np.int64)
    for at in range(0, n, _AT_ONCE):
        cut = map(slice, starts[at : at + _AT_ONCE].tolist(), ends[at : at + _AT_ONCE].tolist())
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cut), repeat(42)), ">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, item (the fingerprint as a signed number). Row by row, nothing is shuffled."""
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            items = [text_fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(items, pa.int64())], ["id", "item"])

    return map_arrow(rows, hashed, f"id {rows.schema['id'].dataType.simpleString()}, item bigint")


def golay_keys(items: DataFrame) -> DataFrame:
    """Keys of distinct fingerprints: bucket, item, side."""

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("item").to_numpy()
            row, bucket, side = bucket_keys(prints)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), pa.array(prints[row]), pa.array(side)], ["bucket", "item", "side"]
            )

    return map_arrow(items.select("item"), keys, "bucket bigint, item bigint, side tinyint")


def within(bits: int):
    def near(a: Column, b: Column) -> Column:
        return F.bit_count(a.bitwiseXOR(b)) <= bits

    return near


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    bits: int = MAX_BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits), component_id (smallest id linked to it, itself included).

    Fingerprints at `bits` or fewer differing bits (four at most, which the keys are made for) are
    linked, directly or through others. Equal fingerprints are one item, so copies make no pairs.
    A null text is an empty one; texts without words have fingerprint zero and are linked like all
    others. Rows with a null id get the class of their fingerprint, which may be null if no row of
    the class has an id; repeated rows come out as often as they come in. Other columns are not
    read. An empty table gives an empty result.
    """
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"bits has to be 0 to {MAX_BITS}")
    prints, _ = stored(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    least = prints.groupBy("item").agg(F.min("id").alias("least"))
    linked = linked_classes(golay_keys(least), within(bits))
    placed = least.join(linked, "item", "left").withColumn("root", F.coalesce("root", "item"))
    classes = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.select("item", "root").join(classes, "root").select("item", "component_id")
    return prints.join(named, "item").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("item"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each class the document with the smallest id.

    Its columns come back unchanged. Of repeated rows of that id one stays. Rows without an id cannot be
    named by a class and all stay.
    """
    name = parameters.get("id_column", "doc_id")
    found = near_duplicates(docs, **parameters)
    kept = found.where(F.col("component_id") == F.col(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    kept, _ = stored(kept.select(F.col(name).alias("_kept"), F.col("n").alias("_n")), "kept")
    # A merge at every size, so that the texts' move grows in proportion to them.
    chosen = lambda rows: docs.join(rows.hint("merge"), F.col(name) == F.col("_kept"), "left_semi")
    found = chosen(kept.where("_n = 1")).unionByName(docs.where(F.col(name).isNull()))
    repeated = kept.where("_n > 1")
    return found if repeated.isEmpty() else found.unionByName(chosen(repeated).dropDuplicates([name]))
