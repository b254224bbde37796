"""N-best segmentation into the pieces of a SentencePiece model, and back to text.

Segmentations are paths through the lattice of a text's pieces, as good as the sum of their scores. A forward
Viterbi pass finds the best score of reaching each position. For a search from the end backwards that is
the exact rest cost, so A-star completes paths in order of their score and never expands a partial path
that is not the beginning of the next best one, but for ties.

No piece has a word mark after other characters, so the lattice falls apart at words. The forward pass alone
tells the best path of a word and what the second one loses: the least loss of the second choices along the
best path. The n best of a text differ from its best in at most n - 1 words, those that lose least, and only
these are searched. Both are remembered by word. The forward pass of new words runs over many words at once, a
position after the other, in arrays. Everything is done row by row, nothing is shuffled.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from changetide.llm.common import map_arrow, slices, text_or_empty

MARK = "▁"
#: Words remembered by a worker, twice as many at most, searched ones, and the longest.
REMEMBERED, SEARCHED, LONGEST = 250_000, 50_000, 64
#: Characters of texts whose new words are searched together, and words that are at once.
TOGETHER, AT_ONCE = 1 << 20, 1 << 14
#: A character without a piece is spelt in bytes, at this much below the lowest score.
UNKNOWN = 10.0


class Word(NamedTuple):
    """Ids of the best segmentation, its score, and how much less the second scores (infinite: there is none)."""

    ids: tuple[int, ...]
    score: float
    loss: float


class Segmentation(NamedTuple):
    """One of the best of a text: its score, and what it has in place of ids[start:end] of the best, by start."""

    score: float
    changes: tuple[tuple[int, int, tuple[int, ...]], ...]

    def of(self, ids: list[int]) -> list[int]:
        """All ids, from those of the best."""
        whole = list(ids)
        for start, end, other in reversed(self.changes):
            whole[start:end] = other
        return whole


class Tree:
    """A tree of pieces in arrays. Nodes are numbered from 1; 0 stands for none."""

    def __init__(self, trie: dict[str, list]):
        letters, edges, scores, ids = {}, [], [float("nan")], [-1]
        waiting: list[tuple[int, dict]] = [(0, trie)]
        for parent, children in waiting:
            for letter, (below, score, piece) in children.items():
                edges.append((parent, letters.setdefault(letter, len(letters) + 1), len(scores)))
                waiting.append((len(scores), below))
                scores.append(float("nan") if score is None else score)
                ids.append(piece)
        self.scores, self.ids = np.array(scores), np.array(ids, np.int32)
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(x) for x in letters]] = list(letters.values())
        self.n_letters = len(letters) + 1
        self.roots = np.zeros(self.n_letters, np.int64)
        self.roots[[x for p, x, _ in edges if not p]] = [k for p, _, k in edges if not p]
        keys = np.array([p * self.n_letters + x for p, x, _ in edges])
        order = np.argsort(keys)
        self.keys, self.nodes = keys[order], np.array([k for _, _, k in edges])[order]

    def letters(self, text: str) -> np.ndarray:
        return self.letter[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def children(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        keys = node * self.n_letters + letter
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.nodes[at], 0)


class Segmenter:
    def __init__(self, model: bytes, best: int):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.best = best
        self.scores: dict[str, tuple[float, int]] = {}
        self.bytes = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
            elif not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)):
                self.scores[piece] = (self.model.get_score(i), i)
        if any(MARK in p.lstrip(MARK) for p in self.scores):
            raise ValueError("a piece goes beyond a word")
        self.lowest = min(s for s, _ in self.scores.values()) - UNKNOWN
        # Pieces by text, and None for texts that longer pieces begin with.
        self.begins = {p[:k]: None for p in self.scores for k in range(1, len(p))} | self.scores
        # The same as a tree by character: children, score (None: no piece ends here), id.
        self.trie: dict[str, list] = {}
        for piece, (score, i) in self.scores.items():
            children = self.trie
            for character in piece:
                node = children.setdefault(character, [{}, None, -1])
                children = node[0]
            node[1:] = score, i
        self.tree = Tree(self.trie)
        spelt = {i: bytes([b]) for b, i in self.bytes.items()}
        self.spelling = [spelt.get(i) or self.model.id_to_piece(i).encode() for i in range(self.model.get_piece_size())]
        self.words: dict[str, Word] = {}
        self.older: dict[str, Word] = {}
        self.searched: dict[str, list[tuple[float, tuple[int, ...]]]] = {}
        self.split = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall

    def forward(self, word: str) -> list[list[tuple[float, int, int]]]:
        """Viterbi: by end position, the last pieces of paths up to there: loss against the best path to that
        position, start, id (-1: a character in bytes); the best first. At the start there are none."""
        begins, size, lowest = self.begins.get, len(word), self.lowest
        ending: list[list] = [[] for _ in range(size + 1)]
        reach = [0.0] * (size + 1)
        for i in range(size + 1):
            here = 0.0
            if last := ending[i]:
                if len(last) == 1:
                    here, at, piece = last[0]
                    last[0] = (0.0, at, piece)
                else:
                    last.sort(reverse=True)
                    here = last[0][0]
                    ending[i] = [(here - s, at, piece) for s, at, piece in last]
                reach[i] = here
            if i == size:
                break
            j = i + 1
            found = begins(word[i:j], self)
            if found is None or found is self:
                ending[j].append((here + lowest, i, -1))
            while found is not self:
                if found is not None:
                    ending[j].append((here + found[0], i, found[1]))
                j += 1
                if j > size:
                    break
                found = begins(word[i:j], self)
        self.reached = reach[size]
        return ending

    def paths(self, word: str, count: int) -> tuple[float, list[tuple[float, list]]]:
        """Score of the best segmentation, and the `count` best (or all): loss and (start, end, id) from the end.

        Every waiting entry is a whole path: a deviation, behind it what was searched, before it the best
        rest. So paths come off the heap in order, and of those waiting only as many as are still
        wanted can matter.
        """
        ending = self.forward(word)
        done: list[tuple[float, list]] = []
        waiting: list[tuple] = [(0.0, 0, len(word), ())]
        number, worst = 0, float("inf")
        while waiting and len(done) < count:
            loss, _, at, behind = heapq.heappop(waiting)
            path = list(behind)
            wanted = count - len(done) - 1
            while at:
                choices = ending[at]
                if wanted and len(choices) > 1:
                    for more, start, piece in choices[1:]:
                        if loss + more >= worst:
                            break
                        number += 1
                        heapq.heappush(waiting, (loss + more, number, start, (*path, (start, at, piece))))
                        if len(waiting) > 2 * wanted:
                            waiting = heapq.nsmallest(wanted, waiting)
                            worst = waiting[-1][0]
                _, start, piece = choices[0]
                path.append((start, at, piece))
                at = start
            done.append((loss, path))
        return self.reached, done

    def ids(self, word: str, path: list) -> list[int]:
        ids = []
        for start, end, piece in reversed(path):
            ids += [piece] if piece >= 0 else [self.bytes[b] for b in word[start:end].encode()]
        return ids

    def viterbi(self, word: str) -> Word:
        """The forward pass with the two best choices at each position only. Of equal ones the longer path before
        the last piece is preferred, as in `forward`."""
        size, lowest, none = len(word), self.lowest, float("-inf")
        first, second = [none] * (size + 1), [none] * (size + 1)
        start, pieces = [0] * (size + 1), [0] * (size + 1)
        first[0] = 0.0
        for i in range(size):
            here, j = first[i], i + 1
            node = self.trie.get(word[i])
            score, piece = (lowest, -1) if node is None or node[1] is None else node[1:]
            while True:
                if score is not None:
                    if (total := here + score) >= first[j]:
                        second[j], first[j], start[j], pieces[j] = first[j], total, i, piece
                    elif total > second[j]:
                        second[j] = total
                if node is None or j == size or not (children := node[0]):
                    break
                node = children.get(word[j])
                if node is None:
                    break
                j += 1
                _, score, piece = node
        path, loss, at = [], float("inf"), size
        while at:
            loss = min(loss, first[at] - second[at])
            path.append((start[at], at, pieces[at]))
            at = start[at]
        return Word(tuple(self.ids(word, path)), first[size], loss)

    def word(self, text: str) -> Word:
        found = self.words.get(text)
        if found is None:
            found = self.older.get(text) or self.viterbi(text)
            self.remember(text, found)
        return found

    def remember(self, text: str, found: Word) -> None:
        if len(text) <= LONGEST:
            if len(self.words) >= REMEMBERED:
                self.older, self.words = self.words, {}
            self.words[text] = found

    def learn(self, texts: Iterable[list[str]]) -> None:
        """Remember the words of some texts that are new. `word` finds the same without it, one by one."""
        older, new = self.older, []
        for word in set().union(*texts).difference(self.words):
            if found := older.get(word):
                self.remember(word, found)
            elif len(word) <= LONGEST:
                new.append(word)
        for k in range(0, len(new), AT_ONCE):
            part = new[k : k + AT_ONCE]
            for word, found in zip(part, self.viterbi_of(part), strict=True):
                self.remember(word, found)

    def viterbi_of(self, words: list[str]) -> list[Word]:
        """`viterbi` of each word: sums and comparisons are the same, in the same order."""
        tree, sizes = self.tree, np.array([len(w) for w in words])
        order = np.argsort(-sizes, kind="stable")  # so that words that go on are the first
        sizes = sizes[order]
        letters = tree.letters("".join([words[k] for k in order.tolist()]))
        begins, places = np.cumsum(sizes) - sizes, np.cumsum(sizes + 1) - sizes - 1
        first = np.full(len(letters) + len(words), -np.inf)
        second, start, pieces = first.copy(), np.zeros(len(first), np.int64), np.zeros(len(first), np.int32)
        first[places] = 0.0
        for i in range(sizes[0]):
            rows = np.arange(np.searchsorted(-sizes, -i))  # longer than i
            sources, j = places[rows] + i, i
            node = tree.roots[letters[begins[rows] + i]]
            score = tree.scores[node]
            none = np.isnan(score)
            score[none], piece = self.lowest, np.where(none, -1, tree.ids[node])
            ends = np.ones(len(rows), bool)
            while True:
                at = sources[ends] if j > i else sources
                to = at + (j + 1 - i)
                total, best = first[at] + (score[ends] if j > i else score), first[to]
                better = total >= best
                second[to] = np.where(better, best, np.maximum(second[to], total))
                to = to[better]
                first[to], start[to], pieces[to] = total[better], at[better], (piece[ends] if j > i else piece)[better]
                j += 1
                on = (node > 0) & (sizes[rows] > j)
                rows, sources = rows[on], sources[on]
                node = tree.children(node[on], letters[begins[rows] + j])
                on = node > 0
                rows, sources, node = rows[on], sources[on], node[on]
                if not len(rows):
                    break
                score, piece = tree.scores[node], tree.ids[node]
                ends = ~np.isnan(score)
        at, loss, used = places + sizes, np.full(len(words), np.inf), np.zeros(len(first), bool)
        rows = np.arange(len(words))
        while len(rows):
            loss[rows] = np.minimum(loss[rows], first[at] - second[at])
            used[at] = True
            at = start[at]
            on = at > places[rows]
            rows, at = rows[on], at[on]
        reached, until = np.flatnonzero(used), np.cumsum(used)[places + sizes].tolist()
        ids = pieces[reached].tolist()
        spelt = np.logical_or.reduceat(used & (pieces < 0), places).tolist()
        found: list = [None] * len(words)
        score, loss, done = first[places + sizes].tolist(), loss.tolist(), 0
        for row, k in enumerate(order.tolist()):
            own = ids[done : until[row]]
            if spelt[row]:
                ends = (reached[done : until[row]] - places[row]).tolist()
                own = self.ids(words[k], list(zip([0, *ends], ends, own, strict=False))[::-1])
            found[k] = Word(tuple(own), score[row], loss[row])
            done = until[row]
        return found

    def others(self, text: str) -> list[tuple[float, tuple[int, ...]]]:
        """Loss and ids of the second and further segmentations of a word, as many as can be wanted."""
        found = self.searched.get(text)
        if found is None:
            found = [(loss, tuple(self.ids(text, path))) for loss, path in self.paths(text, self.best)[1][1:]]
            if len(text) <= LONGEST:
                if len(self.searched) >= SEARCHED:
                    self.searched = {}
                self.searched[text] = found
        return found

    def encode(self, text: str) -> tuple[list[int], list[float]]:
        """Ids of the best segmentation of a text, and the scores of the best ones."""
        ids, ranked = self.n_best(text)
        return ids, [one.score for one in ranked]

    def units(self, text: str) -> list[str]:
        """Words of a text, each with its marks."""
        return self.split(self.model.normalize(text))

    def n_best(self, text: str) -> tuple[list[int], list[Segmentation]]:
        """Ids of the best segmentation of a text, and the best ones (or all), in order."""
        return self.n_best_of(self.units(text))

    def n_best_of(self, units: list[str]) -> tuple[list[int], list[Segmentation]]:
        """The same from the text's units."""
        try:
            found = list(map(self.words.__getitem__, units))
        except KeyError:
            known, search = self.words.get, self.word
            found = [known(u) or search(u) for u in units]
        ids = list(chain.from_iterable(map(itemgetter(0), found)))
        score = sum(map(itemgetter(1), found))
        # At most best - 1 places, those with the smallest loss, can differ from the best path.
        losses = list(map(itemgetter(2), found))
        places: list[int] = []
        if least := sorted(losses)[: self.best - 1]:
            near = [(loss, units[k], k) for k, loss in enumerate(losses) if loss <= least[-1] and loss < float("inf")]
            places = [k for _, _, k in sorted(near)[: self.best - 1]]
        ranked: list[tuple] = [(0.0, ())]
        start = at = 0
        for place in sorted(places):
            start += sum([len(word.ids) for word in found[at:place]])
            at, end = place, start + len(found[place].ids)
            more = [(0.0, ()), *((loss, ((start, end, other),)) for loss, other in self.others(units[place]))]
            ranked = heapq.nsmallest(self.best, ((t + loss, changes + change) for t, changes in ranked for loss, change in more))
        return ids, [Segmentation(score - t, changes) for t, changes in ranked]

    def n_best_each(self, texts: list[str]) -> Iterator[tuple[str, tuple[list[int], list[Segmentation]]]]:
        """Texts, and `n_best` of each; new words of some texts are searched together."""
        start = size = 0
        for k, text in enumerate(texts, 1):
            size += len(text)
            if size >= TOGETHER or k == len(texts):
                group = texts[start:k]
                units = [self.units(t) for t in group]
                self.learn(units)
                yield from zip(group, map(self.n_best_of, units), strict=True)
                start, size = k, 0

    def spelt(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.spelling.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        """Pieces and bytes to text; the mark that encoding put in front goes."""
        return self.spelt(ids).decode(errors="replace").replace(MARK, " ").removeprefix(" ")


def segment(
    docs: DataFrame, model: str, best: int = 3, with_ids: bool = False, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: id, n_bytes, n_pieces, score, scores, ids_crc32, round_trip, all_crc32, variants.

    `score` and what precedes `all_crc32` are of the best segmentation; `scores` and `all_crc32` (as `ids_crc32`, of
    all ids) have a value for each of the `best` ones (or all, if a text has fewer), in order. `variants` says
    what they are: rank (from 2), start, length, ids; from `start` on, `length` ids of the best
    segmentation give way to these. `with_ids` adds `ids`, those of the best, and `segmentations`, all ids of each.
    `round_trip` says whether every one decodes to the text (a text with the word mark itself does not).
    Segmentations are told apart by their ids, and equal scores come in order of the places they change.

    A null text is empty: no pieces, score 0, one segmentation. Rows with null or repeated ids stay as they
    are; other columns are not read. An empty table gives an empty result. The model file is small; its bytes
    go to the workers. Scores are the model's own: of a BPE model they are merge ranks, and the best path is
    not what the library encodes.
    """
    with open(model, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(shared.value, best)
        for batch in slices(batches, "text"):
            columns: dict[str, list] = {n: [] for n in names}
            for text, (ids, found) in segmenter.n_best_each(batch.column("text").to_pylist()):
                raw = np.array(ids, "<u4").tobytes()
                crcs, variants, alike = [], [], segmenter.decode(ids) == text
                for rank, one in enumerate(found, 1):
                    crc, at = 0, 0
                    for start, end, other in one.changes:
                        crc = zlib.crc32(np.array(other, "<u4").tobytes(), zlib.crc32(raw[4 * at : 4 * start], crc))
                        at = end
                        variants.append({"rank": rank, "start": start, "length": end - start, "ids": other})
                        alike = alike and segmenter.spelt(other) == segmenter.spelt(ids[start:end])
                    crcs.append(zlib.crc32(raw[4 * at :], crc))
                scores = [one.score for one in found]
                values = [len(text.encode()), len(ids), scores[0], scores, crcs[0], alike, crcs, variants]
                values += [ids, [one.of(ids) for one in found]] if with_ids else []
                for name, value in zip(names, values, strict=False):
                    columns[name].append(value)
            arrays = [pa.array(columns[n], kind) for n, kind in zip(names, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", *names])

    variant = pa.list_(pa.struct([("rank", pa.int32()), ("start", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))]))
    fields = ["n_bytes bigint", "n_pieces bigint", "score double", "scores array<double>", "ids_crc32 bigint", "round_trip boolean"]
    fields += ["all_crc32 array<bigint>", "variants array<struct<rank: int, start: int, length: int, ids: array<int>>>"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.bool_(), pa.list_(pa.int64()), variant]
    kinds += [pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32()))]
    fields += ["ids array<int>", "segmentations array<array<int>>"] if with_ids else []
    names = [f.split()[0] for f in fields]
    found = map_arrow(rows, work, f"id {rows.schema['id'].dataType.simpleString()}, {', '.join(fields)}")
    return found.withColumnRenamed("id", id_column)
