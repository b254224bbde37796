"""A quality classifier on statistics of the text.

1. Each text becomes a few dozen numbers, made block by block, so that a text of any length takes bounded memory.
2. Random Fourier features of the standardised numbers approximate a Gaussian kernel.
3. Ridge regression of the label: every task sums the normal equations of its rows, the sums are added
   up, one for each of four folds. All labelled training rows count; what moves does not grow with them.
4. Isotonic calibration: each fold is scored by the model of the other three, and the rise of the label over
   these scores is fitted by pooling neighbours that fall.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from changetide.llm.common import map_arrow, slices, stored, text_or_empty
from changetide.session import drop_scratch

#: Characters of a block, label folds, and steps of a score in the calibration table.
BLOCK, FOLDS, STEPS = 1 << 20, 4, 4096
#: Characters whose shares are statistics.
SIGNS = {"symbols": "#*$%&|<>", "marks": ".,;:", "shouts": "!?", "brackets": "()[]{}\\/_=+~^@", "digits": "0123456789"}
_BYTES = [np.frombuffer(s.encode(), np.uint8) for s in SIGNS.values()]
_UPPER = np.arange(65, 91)
_WORD_END = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = [
    "length", "word_length", "long_words", "short_words", "upper", "other_script", *SIGNS, "lines", "repeated_lines", "distinct_words",
    "top_word", "same_as_before", "repeated_triples", "capitals", "shouted", "odd_ends", "links",
]


def blocks(text: str) -> Iterator[str]:
    """A text in parts of about a million characters, cut behind white space where there is some."""
    start = 0
    while len(text) - start > BLOCK:
        cut = max(text.rfind(" ", start, start + BLOCK), text.rfind("\n", start, start + BLOCK)) + 1
        cut = cut if cut > start else start + BLOCK
        yield text[start:cut]
        start = cut
    yield text[start:]


def block_counts(text: str) -> np.ndarray:
    """What is counted in a block; sums over blocks are the text's counts."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    by_byte = np.bincount(raw, minlength=256)
    words = _WORD_END.findall(text)
    n = len(words)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    triples = max(0, n - 2)
    return np.array([
        n, len(text), len(raw), sum(map(len, words)), by_byte[_UPPER].sum(), by_byte[128:].sum(), *(by_byte[b].sum() for b in _BYTES),
        len(lines), len(lines) - len(set(lines)), len(seen), max(seen.values(), default=0),
        sum(map(str.__eq__, words, words[1:])), triples - len(set(zip(words, words[1:], words[2:]))),
        sum(c for w, c in seen.items() if len(w) > 20), sum(c for w, c in seen.items() if len(w) < 3), sum(c for w, c in seen.items() if w[0].isupper()),
        sum(c for w, c in seen.items() if len(w) > 2 and w.isupper()), sum(c for w, c in seen.items() if not w[-1].isalnum() and w[-1] not in ".,;:!?"),
        sum(c for w, c in seen.items() if "://" in w or "@" in w),
    ], float)


def statistics(text: str) -> list[float]:
    """Numbers that tell of a text as a whole, most of them shares, in the order of NAMES."""
    total = sum(block_counts(b) for b in blocks(text))
    n, chars, size, letters, upper, other = total[:6]
    signs, (lines, again, distinct, top, same, triples, long_, short, capitals, shouted, odd, links) = total[6 : 6 + len(SIGNS)], total[6 + len(SIGNS) :]
    per_word, per_char = 1 / max(n, 1), 1 / max(chars, 1)
    return [
        math.log1p(n), math.log1p(letters * per_word), long_ * per_word, short * per_word, upper * per_char, other / max(size, 1), *(math.sqrt(s * per_char) for s in signs),
        math.log1p(n / max(lines, 1)), again / max(lines, 1), distinct * per_word, top * per_word, same * per_word, triples * per_word,
        capitals * per_word, shouted * per_word, odd * per_word, links * per_word,
    ]


def text_statistics(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per row: id, stats. Row by row, nothing is shuffled."""
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(pa.float64()))], ["id", "stats"])

    return map_arrow(rows, count, f"id {rows.schema['id'].dataType.simpleString()}, stats array<double>")


def is_held_out(identifier: Column) -> Column:
    """Rows whose labels are never learned from; false for a null id."""
    return F.coalesce(F.crc32(identifier.cast("string")) % 5 == 0, F.lit(False))


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows: stats, y, fold. Repeated labels of an id: good if half of them say so."""
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~is_held_out(F.col("id")))
        .groupBy("id")
        .agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    )
    fold = (F.crc32(F.col("id").cast("string")) % 5 - 1).cast("int").alias("fold")
    # Labels may be as many as the texts: merged at every size.
    return stats.join(known.hint("merge"), "id").select("stats", "y", fold)


@dataclass(frozen=True)
class Fourier:
    """Random Fourier features of standardised statistics, and a constant."""

    centre: np.ndarray
    scale: np.ndarray
    waves: np.ndarray  # (statistics, features)
    phases: np.ndarray

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        standard = np.clip((stats - self.centre) / self.scale, -8, 8)
        cosines = np.cos(standard @ self.waves + self.phases) * math.sqrt(2 / len(self.phases))
        return np.hstack([cosines, standard / 8, np.ones((len(stats), 1))])


@dataclass(frozen=True)
class Model:
    fourier: Fourier
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]  # scores, and the share of good ones there

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.fourier(stats) @ self.weights, *self.steps)


def _as_matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit_fourier(training: DataFrame, features: int, width: float, seed: int) -> Fourier:
    """Centre and scale over all training rows; waves of a Gaussian kernel `width` standard units wide per root of a statistic."""
    size = len(NAMES)
    told = training.agg(*(f(F.get("stats", F.lit(i))).alias(f"{n}{i}") for i in range(size) for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    centre = np.array([told[f"m{i}"] or 0.0 for i in range(size)])
    scale = np.array([told[f"s{i}"] or 0.0 for i in range(size)])
    rng = np.random.default_rng(seed)
    waves = rng.normal(size=(size, features)) / (width * math.sqrt(size))
    return Fourier(centre, np.where(scale > 1e-9, scale, 1.0), waves, rng.uniform(0, 2 * math.pi, features))


def normal_equations(training: DataFrame, fourier: Fourier) -> np.ndarray:
    """Per fold the sums over all rows of z zᵀ and z y, z being the features: (folds, features, features + 1).

    A task sums its rows and hands out each line of the sums once; equal lines are added by Spark, so
    the driver gets one matrix a fold, whatever the number of rows.
    """
    size = len(fourier.phases) + len(NAMES) + 1

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((FOLDS, size, size + 1)), set()
        for batch in batches:
            z, y, folds = fourier(_as_matrix(batch.column("stats"))), batch.column("y").to_numpy(), batch.column("fold").to_numpy()
            for fold in np.unique(folds):
                part = z[folds == fold]
                total[fold] += part.T @ np.column_stack([part, y[folds == fold]])
                seen.add(int(fold))
        for fold in sorted(seen):
            lines = pa.array([row.tobytes() for row in total[fold]], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([fold] * size, pa.int32()), pa.array(range(size), pa.int32()), lines], ["fold", "line", "sums"])

    def merge(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1)
        for batch in parts:
            for sums in batch.column("sums"):
                total += np.frombuffer(sums.as_buffer(), float)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["fold", "line", "sums"])

    schema = "fold int, line int, sums binary"
    merged = map_arrow(training, add, schema).groupBy("fold", "line").applyInArrow(merge, schema)
    equations = np.zeros((FOLDS, size, size + 1))
    for row in merged.toLocalIterator():
        equations[row["fold"], row["line"]] = np.frombuffer(bytes(row["sums"]), float)
    return equations


def solve(equations: np.ndarray, penalty: float) -> np.ndarray:
    """Ridge weights; the penalty is per row, the constant goes free."""
    size = len(equations)
    ridge = np.eye(size) * penalty * max(1.0, equations[-1, size - 1])
    ridge[-1, -1] = 1e-9
    return np.linalg.solve(equations[:, :size] + ridge, equations[:, size])


def rising(scores: np.ndarray, shares: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic fit: neighbours of which the later has the lower share are pooled. Returns places and shares."""
    pools: list[list[float]] = []
    for x, y, n in zip(scores, shares, counts, strict=True):
        pools.append([x, y, n])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            (a, b, m), (x2, y2, k) = pools[-2], pools.pop()
            pools[-1] = [(a * m + x2 * k) / (m + k), (b * m + y2 * k) / (m + k), m + k]
    found = np.array(pools, float).reshape(-1, 3)
    return found[:, 0], found[:, 1]


def calibrate(training: DataFrame, fourier: Fourier, by_fold: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic calibration on scores by models that have not seen a row's fold, counted in steps of 1/4096."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, folds = fourier(_as_matrix(batch.column("stats"))), batch.column("fold").to_numpy()
            found = np.einsum("ij,ij->i", z, np.stack(by_fold)[folds])
            step = np.round(np.clip(found, -1, 2) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column("y")], ["step", "y"])

    counted = map_arrow(training, score, "step int, y int").groupBy("step").agg(F.sum("y").alias("good"), F.count(F.lit(1)).alias("n"))
    rows = sorted(map(tuple, counted.collect()))
    columns = np.array(rows, float).reshape(-1, 3)
    # Half a row of either kind at the ends: no share is quite 0 or 1.
    good, n = columns[:, 1].copy(), columns[:, 2].copy()
    for end, extra in ((0, 0.0), (-1, 1.0)):
        good[end] += extra / 2
        n[end] += 0.5
    return rising(columns[:, 0] / STEPS, good / n, n)


def train(stats: DataFrame, labels: DataFrame, features: int = 384, width: float = 1.0, penalty: float = 1e-5, seed: int = 7) -> Model | float:
    """A model of all labelled rows outside the held-out fifth; the share of good ones, 0.5 if there are no rows, if they are of one kind."""
    spark = stats.sparkSession
    training, folder = stored(labelled(stats, labels), "training")
    kinds = {r["y"]: r["n"] for r in training.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(kinds) < 2:
        drop_scratch(spark, folder)
        return (kinds.get(1, 0) + 0.5) / (sum(kinds.values()) + 1)
    fourier = fit_fourier(training, features, width, seed)
    equations = normal_equations(training, fourier)
    whole = equations.sum(axis=0)
    by_fold = [solve(whole - equations[f], penalty) for f in range(FOLDS)]
    model = Model(fourier, solve(whole, penalty), calibrate(training, fourier, by_fold))
    drop_scratch(spark, folder)
    return model


def score_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_column: str = "doc_id", text_column: str = "text", **parameters
) -> DataFrame:
    """Per row: id, held_out, score (0 to 1), predicted (1 from the threshold on).

    Only the text decides a score: its statistics are made once, stored, learned from and scored. Null and empty
    texts get the score of an empty text; a null id is not held out; repeated rows are scored alike; other
    columns are not read. Without labels of both kinds every row gets the share of good labels (0.5
    without any). No documents, no rows.
    """
    stats, _ = stored(text_statistics(docs, id_column, text_column), "statistics")
    model = train(stats, labels, **parameters)
    kind = stats.schema["id"].dataType.simpleString()

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.full(len(batch), model) if isinstance(model, float) else model.scores(_as_matrix(batch.column("stats")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.float64())], ["id", "score"])

    scored = map_arrow(stats, score, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_column),
        is_held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
