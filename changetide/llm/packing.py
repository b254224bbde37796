"""Packing documents into sequences of fixed length by the sum of squares.

A document goes where the sum, over all residual gaps, of the squared number of open bins with that gap
becomes smallest. Only sizes matter for that, so the pieces are dealt at random (by a hash) to groups
of a bounded size, each packed by one task: at 32,768 pieces a group about three sequences in a thousand
are more than their tokens need. Token ids are made in the tasks that read the texts and
are not shuffled unless asked for.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from changetide.llm.common import map_arrow, slices, ship, stored, text_or_empty

#: Pieces of a packing group, on average.
GROUP = 32_768
_NOWHERE = 1 << 60
#: Runs of white space that are encoded apart. Fixed value: the characters that the word pattern takes for it.
_LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}").finditer


def cut(length: int, most: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: only the first may be shorter than `most`."""
    first = (length - 1) % most + 1
    return [(0, first)] + [(at, most) for at in range(first, length, most)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Encoder:
    """Token ids of texts in one worker.

    The library's word pattern fails on very long white space, as it looks ahead behind it. That of a long run is known:
    one word up to its last character, which goes with what follows, or up to the end of the text. So
    such runs are cut out and encoded as the words they are.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, special: dict[str, int]):
        self.encoding = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        start, parts = 0, []
        for run in _LONG_BLANK(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            parts.append(self.encoding.encode_to_numpy(text[start : run.start()], allowed_special="all"))
            parts.append(np.array(self.encoding._encode_single_piece(text[run.start() : end]), "<u4"))
            start = end
        parts.append(self.encoding.encode_to_numpy(text[start:], allowed_special="all"))
        return np.concatenate(parts) if len(parts) > 1 else parts[0]


def token_pieces(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    special: dict[str, int],
    end: int,
    most: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of tokenised documents: id, piece, start, length, ids_crc32, and the ids themselves if asked for.

    Special strings in a text become their token. Ranks and pattern are bounded by the vocabulary.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern, special))
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(*shared.value)
        for batch in slices(batches, "text"):
            parent, columns = [], ([], [], [], [], [])
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encode(text), end).astype("<u4")
                for number, (start, length) in enumerate(cut(len(ids), most)):
                    own = ids[start : start + length]
                    parent.append(row)
                    for column, value in zip(columns, (number, start, length, zlib.crc32(own.tobytes()), own), strict=True):
                        column.append(value)
            arrays = [
                batch.column("id").take(pa.array(parent, pa.int64())),
                pa.array(columns[0], pa.int32()),
                *(pa.array(c, pa.int64()) for c in columns[1:4]),
            ]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([own.astype(np.int64) for own in columns[4]], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"id {rows.schema['id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_arrow(rows, pieces, schema + (", ids array<bigint>" if with_ids else ""))


class SumOfSquares:
    """Bins of one group. Bins of equal gap are alike, so each gap keeps a stack of them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open = np.zeros(capacity + 1, np.int64)  # open bins by gap; gap 0 and whole bins don't count
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bins = 0

    def place(self, size: int, planned: int) -> tuple[int, int]:
        """Bin and offset for a piece.

        From gap g to g - size the sum changes by 2 (N(g-size) - N(g)) + 2; a full bin leaves it, a new
        one comes in. Of equal changes the smallest gap wins; a new bin is taken last, and beyond
        the `planned` number of bins only if the piece fits nowhere else.
        """
        n, c = self.open, self.capacity
        gaps = n[size : c + 1]
        change = 2 * (n[: c + 1 - size] - gaps) + 2
        change[0] = 1 - 2 * gaps[0]  # the bin becomes full
        change = np.where(gaps > 0, change, _NOWHERE)
        best = int(change.argmin())
        fresh = 1 + 2 * int(n[c - size]) if self.bins < planned else _NOWHERE - 1
        gap = size + best
        if change[best] <= fresh:
            bin_ = self.stacks[gap].pop()
            n[gap] -= 1
        else:
            bin_, gap = self.bins, c
            self.bins += 1
        if left := gap - size:
            n[left] += 1
            self.stacks[left].append(bin_)
        return bin_, c - gap


def pack_sizes(sizes: np.ndarray, capacity: int, early: float = 0.97) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size, larger ones placed first.

    The sum of squares alone opens bins to keep gaps varied, which pays off for endless input. As all
    sizes are known, only `early` of the bins that their sum needs are planned.
    """
    bins, offsets, packer = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), SumOfSquares(capacity)
    planned = int(early * sizes.sum() / capacity)
    for i in np.argsort(-sizes, kind="stable").tolist():
        bins[i], offsets[i] = packer.place(int(sizes[i]), planned)
    return bins, offsets


def pack(pieces: DataFrame, capacity: int, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to pieces with a length of 1 to `capacity`; all rows and columns stay.

    `pieces` is read twice and in the same order, so hand in stored rows. Sequences have no gap.
    Repeated rows are pieces of their own. Groups are dealt by a seeded number, not by any key, so
    nothing can be hot. An empty table gives an empty one. A column `_group` must not be there.
    """
    ship(pieces.sparkSession)
    groups = max(1, -(-pieces.count() // group))
    dealt = pieces.withColumn("_group", F.floor(F.rand(11) * groups))

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = pack_sizes(frame["length"].to_numpy(np.int64), capacity)
        frame["sequence_id"], frame["offset"] = frame["_group"].to_numpy(np.int64) * (1 << 32) + bins, offsets
        return frame.drop(columns="_group")

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("_group").applyInPandas(fill, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    special: dict[str, int],
    end: int = 2,
    capacity: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per piece of a document: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its tokens and the id `end`; only one longer than `capacity` is cut. A null text is
    empty and gives the one token `end`. Null and repeated ids are documents like all others; other
    columns are not read.
    """
    pieces, _ = stored(
        token_pieces(docs, load_ranks(ranks), pattern, special, end, capacity, id_column, text_column), "pieces"
    )
    return pack(pieces, capacity).withColumnRenamed("id", id_column)
