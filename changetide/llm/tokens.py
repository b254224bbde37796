"""Token counts by whole-token look-up.

Of a vocabulary of word tokens it is proved once, by encoding each string alone, which strings are
one token. Words of a text that are in this set are counted by look-up; only the rest is merged by
the library. Everything is done row by row: nothing is shuffled and no key can be hot.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from changetide.llm.common import map_arrow, slices, text_or_empty

#: Words remembered by a worker besides the proven ones; beyond this it forgets them all.
REMEMBERED = 400_000


def load_tokenizer(definition: str) -> Tokenizer:
    """The library's tokenizer without truncation and padding."""
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def stable_characters() -> str:
    """Character class of what Unicode 3.2 had assigned, and surrogates.

    Normal form, lower case and class of these no longer change, so Python and the library agree on
    them whatever versions they follow.
    """
    old, ranges = unicodedata.ucd_3_2_0, []
    for code in range(sys.maxunicode + 1):
        if old.category(chr(code)) != "Cn":
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def read_rules(definition: str) -> tuple[str, list[str]]:
    """Word pattern and special strings of a lower-casing word tokenizer; ValueError for other kinds."""
    parsed = json.loads(definition)
    normalizers = [n["type"] for n in (parsed["normalizer"] or {}).get("normalizers", [])]
    steps = (parsed["pre_tokenizer"] or {}).get("pretokenizers", [])
    if normalizers != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
        raise ValueError("expected NFC, collapsed space, lower case, and words split by a pattern")
    added = parsed["added_tokens"]
    if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError("special tokens have to be plain strings")
    return steps[0]["pattern"]["Regex"], [t["content"] for t in added]


def whole_tokens(definition: str) -> list[str]:
    """Strings of the vocabulary that, standing alone, are one word and encode as one token."""
    tokenizer = load_tokenizer(definition)
    pattern, special = read_rules(definition)
    word = regex.compile(pattern)
    decoded = {chr(c): b for b, c in byte_letters().items()}
    strings = []
    for entry in tokenizer.get_vocab():
        if entry.endswith("</w>") and entry not in special:
            try:
                text = bytes(decoded[c] for c in entry.removesuffix("</w>")).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if text and word.fullmatch(text) and text == tokenizer.normalizer.normalize_str(text):
                strings.append(text)
    encoded = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    return [text for text, e in zip(strings, encoded, strict=True) if len(e.ids) == 1]


def byte_letters() -> dict[int, int]:
    """Code point that stands for each byte in a byte-level vocabulary: itself if visible, else from 256 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: b for b in visible} | {b: 256 + i for i, b in enumerate(hidden)}


class WordCounter:
    """Counts the tokens of texts in one worker."""

    def __init__(self, definition: str, whole: Iterable[str], stable: str):
        self.tokenizer = load_tokenizer(definition)
        pattern, special = read_rules(definition)
        self.words = regex.compile(pattern).findall
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.unstable = re.compile(f"[^{stable}]").search
        self.odd_words = regex.compile(rf"\S*[^{stable}]\S*")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for entry, i in vocabulary.items() if entry.endswith("</w>")]] = True
        self.whole = dict.fromkeys(whole, 1)
        self.known = dict(self.whole)

    def merged(self, words: list[str]) -> list[int]:
        """Tokens of each word: all are encoded as one text, where a word ends with a token that ends words."""
        ids = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        return np.diff(np.flatnonzero(self.ends[ids]), prepend=-1).tolist()

    def count(self, text: str) -> int:
        total, parts = 0, [text]
        if self.special is not None and (found := self.special.findall(text)):
            total, parts = len(found), self.special.split(text)
        for part in parts:
            if not part.isascii():
                if self.unstable(part):
                    odd = self.odd_words.findall(part)
                    total += len(self.tokenizer.encode_batch_fast([" ".join(odd)], add_special_tokens=False)[0].ids)
                    part = self.odd_words.sub(" ", part)
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                if not unicodedata.is_normalized("NFC", part.lower()):  # as of İ with a mark: not to be composed again
                    total += len(self.tokenizer.encode_batch_fast([part], add_special_tokens=False)[0].ids)
                    continue
            words = self.words(part.lower())
            known = self.known
            if rest := [w for w in set(words) if w not in known]:
                if len(known) + len(rest) > REMEMBERED + len(self.whole):
                    known = self.known = dict(self.whole)
                    rest = [w for w in set(words) if w not in known]
                known.update(zip(rest, self.merged(rest), strict=True))
            total += sum(map(known.__getitem__, words))
        return total


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = 2048, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    `tokenizer` is the path of a tokenizer file; its text and the proven strings (both bounded by the
    vocabulary) go to the workers. Special strings in a text count as the library counts them. A
    null text is an empty one: 0 bytes, 0 tokens. Rows with a null or repeated id are kept as they
    are; other columns are not read. An empty table gives an empty result.
    """
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((definition, whole_tokens(definition), stable_characters()))
    rows = docs.select(
        F.col(id_column).alias("id"), text_or_empty(text_column).alias("text")
    ).withColumn("n_bytes", F.octet_length("text").cast("long"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WordCounter(*shared.value)
        for batch in slices(batches, "text"):
            n = [counter.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    counted = map_arrow(rows, count, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
