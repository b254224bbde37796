"""Toxicity by weak supervision.

1. Terms (words, and stems of four to eight letters) that training labels show to be much more frequent in
   toxic documents are counted over all labelled training documents.
2. Voters: word lists per language, patterns, and lists of mined terms. Each votes on every document;
   votes are counted by pattern, at most 2^12 of them.
3. A generative model of two classes gets, by expectation-maximisation over those counts, each voter's
   rate in either class, its accuracy, and the correlations of voters within a class; voters that
   repeat each other count less. Known training labels hold their documents in place.
4. A linear classifier over the terms learns the model's posteriors and scores whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from changetide.llm.common import map_arrow, ship, slices, stored, text_or_empty
from changetide.session import drop_scratch

#: Plain insults to start from, one voter a language.
LEXICONS = (
    frozenset("idiot moron stupid dumb fool loser scum trash garbage worthless pathetic disgusting clown jerk creep".split()),
    frozenset("idiot trottel dummkopf depp abschaum versager widerlich wertlos erbärmlich müll".split()),
    frozenset("idiot idiote imbécile crétin abruti ordure minable dégoûtant pathétique nul".split()),
    frozenset("idiota imbécil estúpido tonto basura escoria asqueroso patético inútil payaso".split()),
)
MINED_VOTERS = 6
PATTERNS = [len(LEXICONS), len(LEXICONS) + 1]
VOTERS = len(LEXICONS) + len(PATTERNS) + MINED_VOTERS
STEMS = (4, 5, 6, 7, 8)
#: Parts that texts are dealt to by their hash, for samples.
_PARTS = 1 << 20
_WORDS = re.compile(r"[^\W\d_]+").findall
_SHOUTED = re.compile(r"\b[A-Z]{3,}\b").findall
_MASKED = re.compile(r"[A-Za-z][*@$#]+[A-Za-z]").search


def text_words(text: str) -> set[str]:
    return set(_WORDS(text.lower()))


def terms_of(words: Iterable[str]) -> set[str]:
    """Words, and stems marked by a star."""
    found = set(words)
    for w in list(found):
        found.update(w[:k] + "*" for k in STEMS if len(w) >= k)
    return found


class TermFinder:
    """Finds which of some terms a set of words has."""

    def __init__(self, terms: Iterable[str]):
        self.terms = frozenset(terms)
        self.starts = frozenset(t.rstrip("*")[: STEMS[0]] for t in self.terms)

    def __call__(self, words: set[str]) -> set[str]:
        few = [w for w in words if w[: STEMS[0]] in self.starts]
        return terms_of(few) & self.terms if few else set()


@dataclass(frozen=True)
class Model:
    """Terms with their weights, a constant, and the voters' estimates for reports."""

    weights: dict[str, float]
    bias: float
    accuracies: tuple[float, ...]
    correlations: tuple[tuple[float, ...], ...]

    def scores(self, texts: Iterable[str], finder: TermFinder) -> list[float]:
        logits = [self.bias + sum(self.weights[t] for t in sorted(finder(text_words(x)))) for x in texts]
        return (1 / (1 + np.exp(-np.clip(logits, -30, 30)))).tolist()


def is_held_out(identifier: Column) -> Column:
    """Rows whose labels are never learned from; false for a null id."""
    return F.coalesce(F.crc32(identifier.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Texts with a label that may be learned from: text, y. Repeated labels of an id: toxic if half of them say so."""
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~is_held_out(F.col("id")))
        .groupBy("id")
        .agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    )
    texts = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    # Labels may be as many as the texts: merged at every size.
    return texts.join(known.hint("merge"), "id").select("text", "y")


def count_terms(rows: DataFrame, among: frozenset[str] | None) -> DataFrame:
    """Documents by term, combined within tasks; only terms of a given set, if there is one: term, n."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = TermFinder(among) if among is not None else terms_of
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(finder(text_words(text)))
            if len(seen) > 300_000:
                yield pa.RecordBatch.from_pydict({"term": list(seen), "n": pa.array(seen.values(), pa.int64())})
                seen.clear()
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(seen), pa.string()), "n": pa.array(seen.values(), pa.int64())})

    return map_arrow(rows.select("text"), count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def mine_terms(training: DataFrame, most: int, least_share: float = 0.001) -> list[str]:
    """Up to `most` terms by how much, and how often, they speak for label 1, best first.

    A term needs three toxic documents and a thousandth of them. So there are at most a
    thousand times as many as a document has terms, however many documents there are. Its frequency in
    toxic documents has to be beyond chance, given how many terms were looked at (by the relative
    entropy bound).
    """
    size = {r["y"]: r["count"] for r in training.groupBy("y").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return []
    support = max(3, least_share * n1)
    toxic = {r["term"]: r["n"] for r in count_terms(training.where("y = 1"), None).where(F.col("n") >= support).collect()}
    clean = {r["term"]: r["n"] for r in count_terms(training.where("y = 0"), frozenset(toxic)).collect()}
    worth, share = {}, n1 / (n1 + n0)
    # What chance alone would hardly do to any of the terms looked at.
    least = np.log(len(toxic) + 1) + 2
    for term, n in toxic.items():
        part = n / (n + clean.get(term, 0))
        if part > max(0.8, share):
            against = (1 - part) * np.log((1 - part) / (1 - share)) if part < 1 else 0.0
            surprise = n / part * (part * np.log(part / share) + against)
            if surprise > least:
                worth[term] = surprise
    # A stem that only one mined word has says nothing more than that word.
    same = {(stem, toxic[w]) for w in worth if not w.endswith("*") for stem in terms_of([w]) - {w}}
    worth = {t: x for t, x in worth.items() if (t, toxic[t]) not in same}
    return sorted(worth, key=lambda t: (-worth[t], t))[:most]


def voter_lists(mined: list[str]) -> list[frozenset[str]]:
    return [frozenset(mined[i::MINED_VOTERS]) for i in range(MINED_VOTERS)]


def votes_and_terms(rows: DataFrame, mined: list[str], terms: list[str]) -> DataFrame:
    """Adds to rows with text: votes (a bit a voter) and found (places of the terms it has); the text goes."""
    place = {t: i for i, t in enumerate(terms)}
    others = [c for c in rows.columns if c != "text"]

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, lists = TermFinder(terms), voter_lists(mined)
        for batch in slices(batches, "text"):
            votes, found = [], []
            for text in batch.column("text").to_pylist():
                words = text_words(text)
                has = finder(words)
                said = [bool(words & lexicon) for lexicon in LEXICONS]
                said += [len(_SHOUTED(text)) >= 3, _MASKED(text) is not None]
                said += [bool(has & mined_list) for mined_list in lists]
                votes.append(sum(1 << i for i, yes in enumerate(said) if yes))
                found.append(sorted(place[t] for t in has))
            columns = [batch.column(c) for c in others] + [pa.array(votes, pa.int32()), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, [*others, "votes", "found"])

    carried = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in others)
    return map_arrow(rows, vote, f"{carried}votes int, found array<int>")


@dataclass(frozen=True)
class LabelModel:
    """Voters abstain or vote for class 1. A list that abstains while others speak says nothing, as toxic
    documents have few of the terms; that all lists abstain says something."""

    prior: float
    rates: np.ndarray  # (2, voters): how often a voter speaks up in each class
    silence: np.ndarray  # (2,): how often all lists abstain
    discount: np.ndarray  # (voters,)
    correlations: np.ndarray  # (voters, voters), mean over the classes

    def posterior(self, votes: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
        """Probability of class 1 by the votes; a known label counts as one more vote, right in 99 of 100 cases."""
        fired = (votes[:, None] >> np.arange(VOTERS)) & 1
        heard = np.log(self.rates[1] / self.rates[0]) * self.discount
        unheard = np.log((1 - self.rates[1]) / (1 - self.rates[0])) * self.discount
        said = fired @ heard + (1 - fired[:, PATTERNS]) @ unheard[PATTERNS]
        silent = ~np.delete(fired, PATTERNS, axis=1).any(axis=1)
        logit = np.log(self.prior / (1 - self.prior)) + said + silent * np.log(self.silence[1] / self.silence[0])
        if labels is not None:
            logit = logit + np.log(99) * (2 * labels - 1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def accuracies(self) -> np.ndarray:
        return self.prior * self.rates[1] + (1 - self.prior) * (1 - self.rates[0])


def fit_label_model(votes: np.ndarray, known: np.ndarray, counts: np.ndarray, rounds: int = 40) -> LabelModel:
    """Estimates from counted vote patterns; `known` is the label, or -1 where there is none."""
    fired = ((votes[:, None] >> np.arange(VOTERS)) & 1).astype(float)
    is_known = known >= 0
    # At first the lists are believed, the patterns not yet.
    listed = np.delete(fired, PATTERNS, axis=1).any(axis=1)
    p = np.where(is_known, known, np.where(listed, 0.7, 0.02)).astype(float)
    model = None
    for _ in range(rounds if len(votes) else 1):
        weight = np.stack([counts * (1 - p), counts * p])
        total = weight.sum(axis=1)
        rates = (weight @ fired + np.array([[0.1], [1.0]])) / (total[:, None] + 2 * np.array([[5.0], [2.0]]))
        rates = np.clip(rates, 1e-5, 1 - 1e-5)
        prior = float(np.clip((total[1] + 1) / (total.sum() + 20), 1e-4, 0.5))
        both = np.zeros((VOTERS, VOTERS))
        for c in (0, 1):
            off = fired - rates[c]
            spread = np.sqrt(rates[c] * (1 - rates[c]))
            both += (off * weight[c][:, None]).T @ off / max(total[c], 1) / np.outer(spread, spread) / 2
        both = np.clip(both, -1, 1)
        np.fill_diagonal(both, 1)
        discount = 1 / np.maximum(both, 0).sum(axis=1)
        silence = (weight @ ~listed + np.array([9.0, 1.0])) / (total + 10)
        model = LabelModel(prior, rates, silence, discount, both)
        p = np.where(is_known, known, model.posterior(votes))
    return model


def fit_linear(found: list[list[int]], target: np.ndarray, size: int, penalty: float = 0.05, rounds: int = 500) -> tuple[np.ndarray, float]:
    """Logistic regression on present terms against posterior labels, by gradient steps scaled per term."""
    lengths = np.array([len(f) for f in found], int)
    rows = np.repeat(np.arange(len(found)), lengths)
    columns = np.fromiter((i for f in found for i in f), int, lengths.sum())
    weights, bias = np.zeros(size), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    support = np.bincount(columns, minlength=size)
    step = 1 / (0.25 * support * max(1, lengths.max(initial=1)) ** 0.5 + penalty)
    for _ in range(rounds):
        logit = bias + np.bincount(rows, weights[columns], minlength=len(found))
        error = target - 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        weights += step * (np.bincount(columns, error[rows], minlength=size) - penalty * weights)
        bias += 4 / max(1, len(found)) * 0.5 * error.sum()
    return weights, bias


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 20_000,
    terms: int = 2_048,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Model:
    """Learn from all texts and from the labels outside the held-out fifth.

    Terms, votes and the label model come from all rows; only the linear classifier is fitted on a
    bounded sample, by a hash of the text, of at most about `sample` rows with a known label, or of all
    rows if labels are of one kind or missing, with the label model's posteriors. If these call nothing
    toxic the fixed word lists remain, with equal weights.
    """
    spark, folders = docs.sparkSession, []

    def kept(rows: DataFrame, name: str) -> DataFrame:
        table, folder = stored(rows, name)
        folders.append(folder)
        return table

    training = kept(training_rows(docs, labels, id_column, text_column), "labelled")
    mined = mine_terms(training, terms)
    all_terms = list(dict.fromkeys([*mined, *sorted(set().union(*LEXICONS))]))
    place = F.pmod(F.xxhash64("text"), F.lit(_PARTS)).alias("place")
    texts = docs.select(text_or_empty(text_column).alias("text"))
    everything = kept(votes_and_terms(texts.select("text", place), mined, all_terms), "votes")
    labelled = kept(votes_and_terms(training.select("text", place, "y"), mined, all_terms), "labelled-votes")
    counted = {r["votes"]: r["count"] for r in everything.groupBy("votes").count().collect()}
    known = {(r["votes"], r["y"]): r["count"] for r in labelled.groupBy("votes", "y").count().collect()}
    patterns = [(v, y, n) for (v, y), n in sorted(known.items())]
    for v, n in sorted(counted.items()):
        patterns.append((v, -1, max(0, n - known.get((v, 0), 0) - known.get((v, 1), 0))))
    columns = np.array(patterns, int).reshape(-1, 3).T
    model = fit_label_model(columns[0], columns[1], columns[2].astype(float))

    def part(rows: DataFrame, n: int) -> list:
        return rows.where(F.col("place") < int(_PARTS * min(1.0, sample / max(1, n)))).collect()

    with_label = part(labelled, sum(known.values()))
    rows = with_label if len({r["y"] for r in with_label}) > 1 else [*with_label, *part(everything, sum(counted.values()))]
    for folder in folders:
        drop_scratch(spark, folder)
    votes = np.array([r["votes"] for r in rows], int)
    target = model.posterior(votes)
    size = len(with_label)
    target[:size] = model.posterior(votes[:size], np.array([r["y"] for r in with_label], int))
    if not len(target) or target.max() < 0.5:
        weights, bias = np.full(len(all_terms), 3.0), -2.0
    else:
        weights, bias = fit_linear([r["found"] for r in rows], target, len(all_terms))
    used = {t: float(w) for t, w in zip(all_terms, weights, strict=True) if w}
    return Model(used, float(bias), tuple(model.accuracies().tolist()), tuple(map(tuple, model.correlations.tolist())))


def scorer(docs: DataFrame, model: Model):
    """A column function: text to score; a null text is an empty one."""
    ship(docs.sparkSession)

    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = TermFinder(model.weights)
        for series in texts:
            yield pd.Series(model.scores(series.fillna(""), finder), dtype=float)

    return score


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **parameters
) -> DataFrame:
    """Per row: id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Only the text decides a score. Null and empty texts get the score of a text without any term; a null id is
    not held out; repeated rows are scored alike; other columns are not read. Empty tables are
    allowed: no documents, no rows; no labels, the fixed word lists decide.
    """
    model = train(docs, labels, id_column=id_column, text_column=text_column, **parameters)
    score = scorer(docs, model)
    scored = docs.select(F.col(id_column), score(text_or_empty(text_column)).alias("score"))
    return scored.select(
        id_column,
        is_held_out(F.col(id_column)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
