"""Each operator against a brute-force version on small texts: nulls, ties, repeats, odd columns, empty tables."""

import base64
import collections
import hashlib
import itertools
import json
import os
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from changetide.llm import chat, fingerprints, packing, pieces, quality, queries, repeats, simhash, tokens, toxicity, warc

DOCS = "doc_id bigint, text string, source string, id string, item bigint, k bigint, _x string, n_chars bigint"
WORDS = "amber birch cedar delta ember fjord grove heron inlet jetty knoll larch maple north ocean".split()


def prose(seed, words=80):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "."]) for _ in range(words))


def long_text(seed=99):
    return "\n".join(prose(seed + i, 400) for i in range(20))


@pytest.fixture(scope="module")
def texts():
    a = prose(1)
    shared = prose(50, 30)
    return [
        None, "", " \t\n", "one", a, a, a.replace("amber", "AMBER"), a + " tail", "x " + a, prose(2) + " " + shared, prose(3) + "\n" + shared,
        shared + "\n" + shared, "ab" * 300, long_text(), "é" * 60 + "😀" * 40, "Σίσυφος ΟΔΟΣ <|endoftext|> 'll I'VE\x00 \x85\x1c ▁ 漢字", prose(4),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Columns that clash with names used inside; a null id; a row that is there twice."""
    rows = [(i * 3, t, f"s{i % 2}", "c", 1, 2, "y", None) for i, t in enumerate(texts)]
    rows += [(None, prose(5), None, None, None, None, None, None), rows[4], (rows[9][0], prose(6), "s0", "c", 1, 2, "y", None)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def plain(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def bag(rows):
    return collections.Counter(map(repr, rows))


def test_token_counts(docs, plain, spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = [(i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 100) for i, t in plain]
    assert bag(map(tuple, tokens.count_tokens(docs, path, limit=100).collect())) == bag(want)
    assert tokens.count_tokens(spark.createDataFrame([], DOCS), path).count() == 0


def test_whole_tokens_are_proved():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    library, whole = Tokenizer.from_file(path), tokens.whole_tokens(definition)
    assert len(whole) > 30_000
    for word in whole[::997]:
        assert len(library.encode(word, add_special_tokens=False).ids) == 1


def test_counting_any_character():
    """Characters of all planes, alone and between letters, as the library counts them."""
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    counter, library = tokens.WordCounter(definition, tokens.whole_tokens(definition), tokens.stable_characters()), Tokenizer.from_file(path)
    odd = [chr(c) for c in [*range(0, 0x3000, 7), *range(0xA000, 0x1F000, 61)] if not 0xD800 <= c <= 0xDFFF]
    cases = [f"a{c}b {c}{c}'s" for c in odd]
    want = [len(e.ids) for e in library.encode_batch(cases, add_special_tokens=False)]
    assert [counter.count(c) for c in cases] == want


def brute_fingerprint(text, shingle):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, near):
    """Root of each of some values linked directly or through others."""
    values, up = sorted(set(prints)), {}
    for v in values:
        up[v] = v

    def find(v):
        while up[v] != v:
            v = up[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if near(a, b):
            up[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


@pytest.mark.parametrize("bits", [4, 1])
def test_simhash_near_duplicates(docs, plain, bits):
    prints = [brute_fingerprint(t, 4) for _, t in plain]
    roots = brute_classes(prints, lambda a, b: (a ^ b).bit_count() <= bits)
    least = {}
    for (i, _), p in zip(plain, prints, strict=True):
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    want = [(i, f"{p:016x}", least.get(roots[p])) for (i, _), p in zip(plain, prints, strict=True)]
    assert bag(map(tuple, simhash.near_duplicates(docs, 4, bits).collect())) == bag(want)


def test_keys_find_every_pair_within_four_bits():
    rng = np.random.default_rng(7)
    a = rng.integers(0, 1 << 63, 400, dtype=np.int64)
    flips = [rng.choice(64, n, replace=False) for n in rng.integers(0, 5, 400)]
    b = np.array([np.bitwise_xor.reduce([x, *(np.int64(np.uint64(1) << np.uint64(f)) for f in fs)]) for x, fs in zip(a, flips, strict=True)])
    found = []
    for values in (a, b):
        sides = collections.defaultdict(dict)
        for row, key, side in zip(*map(np.ndarray.tolist, simhash.bucket_keys(values)), strict=True):
            sides[row][key] = sides[row].get(key, 0) | side
        found.append(sides)
    for row in range(len(a)):
        assert any(s & 1 and found[1][row].get(k, 0) & 2 for k, s in found[0][row].items())


@pytest.mark.parametrize("centre", [0, 0x9E37_79B9_7F4A_7C15])
def test_keys_meet_at_every_pattern_of_four_bits(centre):
    """All 679,121 fingerprints within four bits share a key with the centre, on opposite sides."""
    patterns = [sum(1 << b for b in bits) for n in range(5) for bits in itertools.combinations(range(64), n)]
    around = np.array(patterns, np.uint64) ^ np.uint64(centre)
    _, keys, sides = simhash.bucket_keys(np.array([centre], np.uint64).view(np.int64))
    own = collections.Counter()
    for key, side in zip(keys.tolist(), sides.tolist(), strict=True):
        own[key] |= side
    known = np.array(sorted(own))
    of_known = np.array([own[k] for k in known.tolist()])
    met = np.zeros((2, len(around)), bool)
    for at in range(0, len(around), 100_000):
        rows, keys, sides = simhash.bucket_keys(around[at : at + 100_000].view(np.int64))
        place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        same = known[place] == keys
        rows, sides, other = rows[same] + at, sides[same], of_known[place[same]]
        met[0, rows[(other & 1 > 0) & (sides & 2 > 0)]] = True
        met[1, rows[(other & 2 > 0) & (sides & 1 > 0)]] = True
    assert met.all()


def test_a_crowd_of_near_copies_is_one_class(spark):
    """Fingerprints around a centre and a far one: one class without a row for each pair."""
    centre = 0x0F0F_3355_1234_7777
    crowd = [centre ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)][:900] + [centre ^ (2**64 - 1) >> 1]
    items = spark.createDataFrame([(c,) for c in crowd], "item bigint")
    from changetide.llm.linking import linked_classes

    classes = linked_classes(simhash.golay_keys(items), simhash.within(4))
    assert classes.count() == 900 and classes.select("root").distinct().count() == 1


def test_classes_of_chains(spark):
    from changetide.llm.linking import classes

    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (100, 102), (7, 7)]
    rows = classes(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    groups = collections.defaultdict(set)
    for item, root in rows:
        groups[root].add(item)
    assert sorted(map(sorted, groups.values())) == [list(range(61)), [100, 101, 102]]


def test_keep_one(docs, plain):
    found = simhash.near_duplicates(docs).collect()
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = {r.component_id for r in found if r.component_id is not None}
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(want)
    assert kept.where("doc_id IS NULL").count() == 1


def brute_signs(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered, seen, again = collections.Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered), n < 50 or 100 * len(covered) > 50 * n


def brute_depleted(rows, rules):
    """Host and text of depleted documents."""
    words = lambda line: len(re.findall(r"[^\x20\x09-\x0D]+", line))
    normal = lambda line: re.sub("[0-9]", "0", re.sub(r"[\x20\x09-\x0D]+", " ", line.lower())).strip(" ")
    hosts = collections.defaultdict(dict)
    for host, text in rows:
        lines = {}
        for line in text.split("\n"):
            if words(line):
                lines[normal(line)] = max(words(line), lines.get(normal(line), 0))
        if lines:
            hosts[host][text] = lines
    gone = set()
    for host, by_text in hosts.items():
        times = collections.Counter(line for lines in by_text.values() for line in lines)
        common = {x for x, n in times.items() if n > rules.line_documents and n > rules.line_share * len(by_text)}
        for text, lines in by_text.items():
            if sum(n for x, n in lines.items() if x not in common) < rules.left_share * sum(lines.values()):
                gone.add((host, text))
    return gone


def test_quality_rules(spark, docs, plain):
    menu = "\n".join(f"Menu {i} " + prose(900 + i, 30) for i in range(3))
    more = [(1000 + i, f"{menu}\n{prose(2000 + i, 20 if i % 3 else 200)}", "hot") for i in range(30)] + [(2000, menu, "cold"), (2001, menu, None)]
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()] + more
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    gone = brute_depleted([(s or "", t or "") for _, t, s in rows], quality.Rules())
    want = [(i, *(x := brute_signs(t or "")), not x[-1] and (s or "", t or "") not in gone) for i, t, s in rows]
    got = quality.quality_rules(table).collect()
    assert bag(map(tuple, got)) == bag(want)
    assert 0 < sum(not r.kept and not r.base_failed for r in got) < 30
    assert bag(quality.keep_good(docs).select("doc_id").collect()) == bag([r for r in quality.quality_rules(docs).where("kept").select("doc_id").collect()])
    assert quality.quality_rules(spark.createDataFrame([], DOCS)).count() == 0


def test_depletion_counts_lines_as_often_as_they_occur(spark):
    menu = [prose(7000 + i, n) for i, n in enumerate((12, 12, 15, 15, 15, 15, 15))]
    rows = [(i, "\n".join([*menu, prose(7100 + i, 300)]), "h") for i in range(30)]
    own, again = prose(7200, 25), prose(7201, 10)
    # Of 100 words: 25 left, as one common line is there four times; 40 left, as an own line is there four times.
    less = "\n".join([menu[0], menu[1], menu[0], menu[2], menu[0], own, menu[0]])
    more = "\n".join([again, menu[3], again, menu[4], again, menu[5], again, menu[6]])
    rows += [(100, less, "h"), (101, more, "h")] + [(200 + i, t, "h") for i, t in enumerate([less, more, more])]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in quality.quality_rules(table).collect()}
    assert all(got[i].n_words == 100 and not got[i].base_failed for i in (100, 101))
    assert {i for i, r in got.items() if not r.kept} == {100, 200}


def test_boilerplate_of_a_hot_host(spark):
    menu = "\n".join(prose(8500 + i, 40) for i in range(3))
    planted = [(i, f"{menu}\n{prose(8600 + i, 20)}", "hot") for i in range(60)]
    others = [(1000 + i, prose(9000 + i, 60), "hot") for i in range(1500)]  # 60 texts are under 5 % of the host
    table = spark.createDataFrame(planted + others, "doc_id bigint, text string, source string")
    gone = lambda rules: {r.doc_id for r in quality.quality_rules(table, rules).where("NOT kept AND NOT base_failed").collect()}
    assert gone(quality.Rules(line_many=50)) == set(range(60))
    assert gone(quality.Rules(line_many=60)) == gone(quality.Rules()) == set()


def test_default_limit_of_very_large_hosts(spark):
    lines = spark.range(250_000).selectExpr("'hot' host", "id text_key", "explode(array(id + 10, if(id < 10001, 1, 2), if(id < 10000, 3, 2))) line").distinct()
    assert {r.line for r in quality.common_lines(lines, quality.Rules()).collect()} == {1, 2}


def test_removing_common_lines(spark):
    rows = [(i, f"Same line 7\nown {i} words\n\nSAME  line 8", "h") for i in range(30)]
    cleaned = quality.remove_common_lines(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    assert {r.text for r in cleaned.collect()} == {f"own {i} words\n" for i in range(30)}


def test_kept_documents_lose_their_common_lines(spark, docs):
    menu = "Menu 7 " + prose(8000, 10)
    texts = [f"{prose(8100 + i, 60)}\n\n{menu}\nown {'x' * i} line\n{menu.upper()}  " for i in range(30)]
    rows = [(i, t, "h", len(t)) for i, t in enumerate([*texts, texts[0]])] + [(50, texts[0], "other", len(texts[0])), (51, "few", "h", 3)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")
    got = quality.clean_good(table)
    assert got.columns == table.columns
    want = {i: t if s == "other" else "\n".join(x for x in t.split("\n") if "MENU" not in x.upper()) for i, t, s, _ in rows if i != 51}
    assert {r.doc_id: r.text for r in got.collect()} == want
    assert all(r.n_chars == len(r.text) for r in got.collect())
    assert bag(quality.clean_good(docs).collect()) == bag(quality.keep_good(docs).collect())  # no line is common
    staged = corpus_pipeline.drop_junk(spark, table, "")
    assert {r.doc_id: r.text for r in staged.collect()} == want


def segmenter(best):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return pieces.Segmenter(file.read(), best)


def every_path(own, text):
    found = []

    def go(at, score, ids):
        if at == len(text):
            found.append(score)
        for end in range(at + 1, len(text) + 1):
            if hit := own.scores.get(text[at:end]):
                go(end, score + hit[0], [*ids, hit[1]])
        if at < len(text) and text[at] not in own.scores:
            go(at + 1, score + own.lowest, ids)

    go(0, 0.0, [])
    return sorted(found, reverse=True)


@pytest.mark.parametrize("text", ["thntblere", "aaaaaaa", "é Ⅳx", "  a b", "the the bé", "x"])
def test_n_best_against_all_paths(text):
    own = segmenter(5)
    assert own.encode(text)[1] == every_path(own, own.model.normalize(text))[:5]


def every_segmentation(own, text):
    """Score and ids of all paths through the lattice."""
    found = []

    def go(at, score, ids):
        if at == len(text):
            found.append((score, tuple(ids)))
        for end in range(at + 1, len(text) + 1):
            if hit := own.scores.get(text[at:end]):
                go(end, score + hit[0], [*ids, hit[1]])
        if at < len(text) and text[at] not in own.scores:
            go(at + 1, score + own.lowest, [*ids, *(own.bytes[b] for b in text[at].encode())])

    go(0, 0.0, [])
    return found


@pytest.mark.parametrize("best", [1, 3, 7])
def test_n_best_segmentations_against_all_paths(best):
    """Ids and scores of random texts of repeated words; where scores tie, any of the tied ids will do."""
    own, rng = segmenter(best), random.Random(best)
    parts = ["the", "re", "an", "é", "Ⅳ", "x", "ing", " ", "a", "aa", "\n"]
    for _ in range(150):
        text = "".join(rng.choices(parts, k=rng.randint(0, 6)))
        text += " " + text if len(text) < 5 else ""
        ids, ranked = own.n_best(text)
        every = every_segmentation(own, own.model.normalize(text))
        wanted = sorted((score for score, _ in every), reverse=True)[:best]
        assert [one.score for one in ranked] == pytest.approx(wanted)
        whole = [tuple(one.of(ids)) for one in ranked]
        assert len(set(whole)) == len(whole) and whole[0] == tuple(ids)
        scores = collections.defaultdict(list)
        for score, path in every:
            scores[path].append(score)
        for one, path in zip(ranked, whole, strict=True):
            assert one.score in [pytest.approx(x) for x in scores[path]]


def test_first_loss_is_that_of_the_search():
    own, rng = segmenter(4), random.Random(5)
    for _ in range(400):
        word = "▁" + "".join(rng.choices(["the", "tion", "é", "Ⅳ", "q", "ea", "a", "r"], k=rng.randint(0, 9)))
        score, ranked = own.paths(word, 2)
        fast = own.viterbi(word)
        assert (fast.score, list(fast.ids)) == (score, own.ids(word, ranked[0][1]))
        assert fast.loss == (ranked[1][0] if len(ranked) > 1 else float("inf"))


def test_variants_give_all_segmentations(docs, spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.segment(docs, path, with_ids=True).collect()
    for r in rows:
        assert len(r.segmentations) == len(r.scores) == len(r.all_crc32) <= 3 and r.segmentations[0] == r.ids
        assert [zlib.crc32(np.array(x, "<u4").tobytes()) for x in r.segmentations] == r.all_crc32
        for rank, want in enumerate(r.segmentations, 1):
            ids = list(r.ids)
            for v in sorted((v for v in r.variants if v.rank == rank), key=lambda v: -v.start):
                ids[v.start : v.start + v.length] = v.ids
            assert ids == want
    assert any(len(r.segmentations) == 3 for r in rows)


def test_segments_of_a_very_long_text(spark):
    long = "a" * 1_200_000 + " end"
    table = spark.createDataFrame([(1, long), (2, None)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in pieces.segment(table, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert rows[1].round_trip and rows[1].n_bytes == len(long) and len(rows[1].scores) == 3
    assert (rows[2].n_pieces, rows[2].all_crc32, rows[2].variants) == (0, [0], [])


def test_sentencepiece_round_trip(docs, plain, spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.segment(docs, path, with_ids=True).collect()
    by_text = collections.defaultdict(list)
    for i, t in plain:
        by_text[i].append(t)
    assert len(rows) == len(plain)
    for r in rows:
        ids = list(r.ids)
        assert (r.n_pieces, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert r.scores == sorted(r.scores, reverse=True) and r.score == r.scores[0]
        assert (library.decode(ids) in by_text[r.doc_id]) or "▁" in "".join(by_text[r.doc_id])
        assert r.round_trip == any(library.decode(ids) == t for t in by_text[r.doc_id])
    assert pieces.segment(spark.createDataFrame([], DOCS), path).count() == 0


def test_document_fingerprints(docs, plain, spark):
    last = 1 << 63
    ordered = sorted({i if i is not None else last for i, _ in plain})
    smallest = {i: min(t for j, t in plain if (j if j is not None else last) == i) for i in ordered}
    want = []
    for i, text in plain:
        place = ordered.index(i if i is not None else last)
        half = len(text) // 2
        edited = text[: len(text) - half] + smallest[ordered[(place + 1) % len(ordered)]][:half]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    rows = fingerprints.fingerprint_documents(docs).collect()
    assert bag((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == bag(want)
    value = lambda hexadecimal: int(hexadecimal, 16)
    roots = brute_classes([value(r.fingerprint) for r in rows], lambda a, b: (a ^ b).bit_count() <= fingerprints.RADIUS)
    least = {}
    for r in rows:
        if r.doc_id is not None:
            least[roots[value(r.fingerprint)]] = min(r.doc_id, least.get(roots[value(r.fingerprint)], r.doc_id))
    for r in rows:
        assert r.near_group == least.get(roots[value(r.fingerprint)])
        assert r.near_edited == 1 - (value(r.fingerprint) ^ value(r.edited_fingerprint)).bit_count() / 128
    same = {r.doc_id: r.fingerprint for r in rows}
    assert same[12] == same[15] and same[0] == same[3] == "0" * 32
    assert fingerprints.fingerprint_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_simhash_votes(spark):
    """The fingerprint by its definition: weighted votes of word pairs."""
    text = "Amber birch cedar birch amber birch"
    words = text.lower().split()
    pairs = spark.createDataFrame([(a, b) for a, b in zip(words, words[1:], strict=False)], "a string, b string")
    hashed = pairs.select(F.xxhash64("a", "b").alias("h"), (F.length("a") + F.length("b")).alias("w")).withColumn("g", F.xxhash64(F.lit(7), "h")).collect()
    weight = sum(r.w for r in hashed)
    half = lambda name: sum(1 << b for b in range(64) if 2 * sum(r.w for r in hashed if r[name] >> b & 1) > weight)
    table = spark.createDataFrame([(1, text)], "k int, text string")
    got = fingerprints.simhash(table, ["k"]).select(fingerprints.hexadecimal(F.col("hi"), F.col("lo"))).first()[0]
    assert got == f"{half('h'):016x}{half('g'):016x}"


def test_packing(docs, plain, spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4") for _, t in plain]
    want = []
    for (i, _), own in zip(plain, ids, strict=True):
        first = (len(own) - 1) % 1024 + 1
        edges = [0, *range(first, len(own) + 1, 1024)]
        want += [(i, n, a, b - a, zlib.crc32(own[a:b].tobytes())) for n, (a, b) in enumerate(itertools.pairwise(edges))]
    rows = packing.pack_documents(docs, **queries.PACKING).collect()
    assert bag((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == bag(want)
    assert_sequences(rows, 1024)
    assert packing.pack_documents(spark.createDataFrame([], DOCS), **queries.PACKING).count() == 0


def assert_sequences(rows, capacity):
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_packing_is_tight(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), int(n)) for i, n in enumerate(rng.integers(1, 1025, 6000))]
    table = spark.createDataFrame(rows, "id bigint, length bigint")
    used = assert_sequences(packing.pack(table, 1024).collect(), 1024)
    assert used <= 1.02 * sum(n for _, n in rows) / 1024 + 1
    used = assert_sequences(packing.pack(table, 1024, group=500).collect(), 1024)
    assert used <= 1.06 * sum(n for _, n in rows) / 1024 + 12


def test_each_choice_has_the_least_sum_of_squares():
    rng = np.random.default_rng(5)
    packer, gaps, c = packing.SumOfSquares(64), [], 64
    for size in rng.integers(1, 65, 300).tolist():
        squares = lambda g: sum(n * n for n in collections.Counter(x for x in g if x).values())
        before = [g for g in gaps if g]
        options = [squares([*(before[:i] + before[i + 1 :]), before[i] - size]) for i in range(len(before)) if before[i] >= size]
        best = min([*options, squares([*before, c - size])])
        number, offset = packer.place(size, 1 << 30)
        if number == len(gaps):
            gaps.append(c)
        assert offset == c - gaps[number] and gaps[number] >= size
        gaps[number] -= size
        assert squares(gaps) == best


@pytest.mark.parametrize("range_bytes", [997, 1 << 20])
def test_archives(spark, tmp_path, range_bytes):
    rows = [(1, "http://a/b c", "x" * 5000), (2, None, "x" * 5000), (3, "u", None), (4, "u", ""), (None, "n", "x" * 5000), (7, "v", "é😀" * 900), (8, "v", "alone"), (8, "v", "alone"), (None, "v", "only")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("_last", F.lit(1)).withColumn("member", F.lit(2))
    got = warc.archive_round_trip(pages, range_bytes=range_bytes).collect()
    best = {}
    for i, _, html in rows:
        if i is not None:
            best[html or ""] = max(i, best.get(html or "", i))
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = best.get(html or "") not in (None, i)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, "revisit" if again else "response", best[html or ""] if again else None))
    assert bag(map(tuple, got)) == bag(want)


def test_archives_are_plain_gzip_and_carry_payloads(spark, tmp_path):
    import gzip

    rows = [(i, "u", prose(i, 50 + i)) for i in range(20)]
    folder = str(tmp_path / "warc")
    warc.write_warc(warc.with_record_types(spark.createDataFrame(rows, "page_id bigint, url string, html string")), folder)
    text = b"".join(gzip.open(os.path.join(folder, f)).read() for f in sorted(os.listdir(folder)) if f.startswith("part-"))
    assert text.count(b"WARC/1.1\r\n") == 20
    back = warc.read_warc(spark, folder, range_bytes=500)
    assert sorted((r.page_id, r.payload.decode()) for r in back.collect()) == sorted((i, h) for i, _, h in rows)
    assert warc.gzip_member(b"y" * (17 << 20))[-1] == 0


def test_archives_report_damage(spark, tmp_path):
    data = warc.gzip_member(warc.record(1, "u", b"payload" * 99, "response", None, "2024-01-01T00:00:00Z"))
    (tmp_path / "cut").write_bytes(data[:-40])
    with pytest.raises(ValueError, match="not complete"):
        list(warc.records(str(tmp_path / "cut"), 0, len(data)))
    (tmp_path / "noise").write_bytes(b"\x1f\x8b\x08" + b"junk" * 50 + data + b"\x1f\x8b\x08\x00 more")
    assert [at for at, _ in warc.records(str(tmp_path / "noise"), 0, 10_000)] == [203]


@pytest.mark.parametrize("place", ["middle", "checksum", "far"])
def test_records_that_do_not_inflate_are_errors(tmp_path, place):
    noise = np.random.default_rng(5).integers(33, 127, 3 * warc.AHEAD if place == "far" else 3000).astype(np.uint8).tobytes()
    data = bytearray(warc.gzip_member(warc.record(1, "u", noise, "response", None, "2024-01-01T00:00:00Z")))
    whole = bytes(data)
    end = len(whole) - len(unused_after(whole))
    at = {"middle": len(data) // 2, "checksum": end - 8, "far": end - 8}[place]
    data[at] ^= 255
    (tmp_path / "damaged").write_bytes(bytes(data) + whole)
    with pytest.raises(ValueError, match="is damaged"):
        list(warc.records(str(tmp_path / "damaged"), 0, len(data) + len(whole)))


def unused_after(data):
    inflater = zlib.decompressobj(warc.GZIP)
    inflater.decompress(data)
    return inflater.unused_data


def brute_repeats(rows, match):
    """By row number: bytes kept, how many went, runs."""
    seen, out = set(), {}
    for number, (_, text) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0)):
        data = text.encode()
        gone = bytearray(len(data))
        for at in range(len(data) - match + 1):
            window = data[at : at + match]
            if window in seen:
                gone[at : at + match] = b"\1" * match
            seen.add(window)
        runs = sum(1 for i in range(len(data)) if gone[i] and not (i and gone[i - 1]))
        out[number] = (len(data), sum(gone), runs, bytes(x for x, y in zip(data, gone, strict=True) if not y))
    return out


@pytest.mark.parametrize("chunk", [400, 1_000_000])
def test_repeated_strings(spark, texts, chunk):
    rows = [(i * 3, t or "") for i, t in enumerate(texts)] + [(None, texts[4]), (500, prose(70) + texts[9][50:400] + prose(71)), (501, "ab" * 80)]
    table = spark.createDataFrame([(*r, "z") for r in rows], "doc_id bigint, text string, id string").repartition(3)
    want = [(rows[n][0], a, b, c, hashlib.sha256(kept).hexdigest()) for n, (a, b, c, kept) in brute_repeats(rows, 100).items()]
    got = repeats.remove_repeats(table, 100, chunk_bytes=chunk).select(
        "doc_id", "_n_bytes", "_n_removed", "_n_spans", F.sha2("_kept", 256)
    )
    assert bag(map(tuple, got.collect())) == bag(want)
    assert bag(map(tuple, repeats.repeat_spans(table).collect())) == bag(want)


def test_repeats_of_random_texts(spark):
    """Small alphabets and short matches make many overlapping repeats."""
    rng = np.random.default_rng(11)
    rows = [(i, "".join(rng.choice(list("ab"), int(rng.integers(0, 900)), p=[0.97, 0.03]))) for i in range(12)]
    want = {rows[n][0]: kept for n, (_, _, _, kept) in brute_repeats(rows, 80).items()}
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: bytes(r._kept) for r in repeats.remove_repeats(table, 80, chunk_bytes=700, bucket_size=64).collect()}
    assert got == want


def test_new_words_are_searched_together():
    """The forward pass over many words at once finds what it finds word by word; none is left to be searched alone."""
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        together, alone = (pieces.Segmenter(model, 3) for model in [file.read()] * 2)
    rng = random.Random(7)
    words = ["▁", "▁▁▁x", "日本語", "▁a😀b", "▁" + "z" * 63, *("".join(rng.choices("▁abetinqu.=-*é日\U0001f600", k=rng.randint(1, 64))) for _ in range(3000))]
    assert together.viterbi_of(words) == [alone.viterbi(w) for w in words]
    texts = ["", "  ", *(" ".join("".join(rng.choices("abehinorst.,é😀", k=9)) for _ in range(60)) for _ in range(50))]
    want = [alone.n_best(t) for t in texts]
    searched = []
    together.viterbi = lambda word: searched.append(word) or alone.viterbi(word)
    assert list(together.n_best_each(texts)) == list(zip(texts, want, strict=True))
    assert not searched


def test_bucket_of_strings_is_sorted_in_little_memory():
    """A bucket is larger than meant where few windows make many candidates; it takes a few bytes a string besides its own."""
    rng, n, chunks = np.random.default_rng(5), 1_000_000, 50

    def bucket(n, space, n_checks):
        keys = [rng.integers(0, space, n // chunks).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(chunks)]
        checks = [rng.integers(0, n_checks, len(k)).astype(np.uint8) for k in keys]
        owners = [np.sort(rng.integers(0, 300, len(k))) for k in keys]
        packed = [[k.tobytes() for k in keys], [c.tobytes() for c in checks], [repeats.owner_bytes(o) for o in owners]]
        names = ["chunk", "bucket", "keys", "checks", "owners"]
        order = rng.permutation(chunks)
        values = [order.tolist(), [3] * chunks, *packed]
        return pa.table([pa.array(v) for v in values], names), {int(c): x for c, *x in zip(order, keys, checks, owners, strict=True)}

    blobs, parts = bucket(20_000, 5_000, 2)
    first = {}
    strings = [(c, i, (int(k), int(m)), int(o)) for c in sorted(parts) for i, (k, m, o) in enumerate(zip(*parts[c], strict=True))]
    for c, i, key, owner in strings:
        if key not in first or owner < first[key][0]:
            first[key] = (owner, c, i)
    kept = {(c, i) for _, c, i in first.values()}
    for got in (repeats.sort_bucket(blobs), repeats.sort_bucket(blobs, 1_000), repeats.sort_bucket(blobs, 1)):
        flags = {r["chunk"]: repeats.unpacked(r["flags"], 20_000 // chunks) for r in got.to_pylist()}
        assert {(c, i) for c, i, _, _ in strings if not flags[c][i]} == kept

    blobs, _ = bucket(n, 1 << 40, 256)
    tracemalloc.start()
    repeats.sort_bucket(blobs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * n


def test_repeats_in_very_long_texts(spark):
    """Runs and short periods put their windows into few buckets; a chunk sends each of them once."""
    rows = [(1, "a" * 1_500_000), (2, "ab" * 600_000 + "c"), (3, "b" + "a" * 99), (4, "c" + "ab" * 60), (5, "")]
    got = {r.doc_id: (r._n_removed, bytes(r._kept).decode()) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), bucket_size=64).collect()}
    assert got[1] == (1_500_000 - 1, "a")
    assert got[2] == (1_200_000 - 2, "abc")
    assert got[3] == (0, rows[2][1]) and got[4] == (120, "c") and got[5] == (0, "")
    chunk = repeats.Chunk(np.full(1_500_000, 97, np.uint8), np.array([1]), np.array([1_500_000]))
    at, keys, _ = chunk.sampled(100, 8)
    assert len(keys) == 1 and len(at) > 200_000


def test_cut_documents_keep_their_columns(docs, spark):
    cut = repeats.cut_documents(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    assert repeats.cut_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_the_cover_has_every_difference():
    found = {(a - b) % repeats.PERIOD for a in repeats.COVER for b in repeats.COVER}
    assert found == set(range(repeats.PERIOD))


def toxic_tables(spark, n=400):
    rng = np.random.default_rng(17)
    rows, marks = [], []
    for i in range(n):
        text, bad = prose(3000 + i, 40).split(), i % 5 == 0
        if bad:
            text.insert(int(rng.integers(len(text))), ["idiot", "vrelkost" + WORDS[i % 7], "scum"][i % 3])
        rows.append((i, " ".join(text), "s"))
        if i % 7 < 4:
            marks.append((i, int(bad)))
    marks += [(None, 1), (7, None), marks[0]]
    rows += [(5000, None, None), (None, "you idiot", None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, score string"), spark.createDataFrame(marks, "doc_id bigint, toxic int")


def test_toxicity(spark):
    docs, labels = toxic_tables(spark)
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == 402
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == (r.doc_id % 5 == 0 and r.doc_id < 400) for r in held)
    assert right >= 0.97 * len(held)
    assert {r.predicted for r in rows if r.doc_id is None} == {1} and {r.predicted for r in rows if r.doc_id == 5000} == {0}


def test_toxicity_never_learns_held_out_labels(spark):
    docs, labels = toxic_tables(spark)
    turned = labels.withColumn("toxic", F.when(toxicity.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, labels) == toxicity.train(docs, turned)


def test_toxicity_without_labels(spark):
    docs, labels = toxic_tables(spark, 20)
    rows = toxicity.score_toxicity(docs, labels.limit(0)).collect()
    assert {r.doc_id for r in rows if r.predicted} == {0, 5, 15, None}
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_label_model_tells_good_voters_from_bad():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.2
    fired = np.zeros((4000, toxicity.VOTERS), bool)
    fired[:, 0] = np.where(truth, rng.random(4000) < 0.9, rng.random(4000) < 0.02)
    fired[:, 1] = fired[:, 0]
    fired[:, 2] = np.where(truth, rng.random(4000) < 0.8, rng.random(4000) < 0.05)
    fired[:, 4] = rng.random(4000) < 0.3
    votes = (fired << np.arange(toxicity.VOTERS)).sum(axis=1)
    known = np.where(rng.random(4000) < 0.3, truth, -1)
    patterns, counts = np.unique(np.stack([votes, known]), axis=1, return_counts=True)
    model = toxicity.fit_label_model(patterns[0], patterns[1], counts.astype(float))
    accuracies = model.accuracies()
    assert accuracies[0] > 0.9 > accuracies[4] and model.correlations[0, 1] > 0.9
    assert model.discount[0] < 0.6 < model.discount[2]
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.93


def brute_chat(turns):
    by_conv = collections.defaultdict(list)
    key = lambda x: (x is not None, x if x is not None else 0)
    for conv, turn, role, text in turns:
        by_conv[conv].append((key(turn), role or "", text or ""))
    states = {c: tuple(sorted(t)) for c, t in by_conv.items()}
    kept = {}
    for conv, own in sorted(states.items(), key=lambda x: (x[0] is None, x[0] or 0)):
        longer = any(len(o) > len(own) and o[: len(own)] == own for o in states.values())
        if not longer and own not in kept.values():
            kept[conv] = own
    show = lambda t: f"<|{t[1]}|>\n{t[2].replace('<|', '< |')}<|end|>\n"
    return [(c, at // 1024, len(own), "".join(map(show, own[at : at + 1024]))) for c, own in kept.items() for at in range(0, len(own), 1024)]


def test_chat_formatting(spark):
    talk = [("user" if i % 2 == 0 else "assistant", prose(i, 6)) for i in range(7)]
    turns = [(c, i, *talk[i]) for c, n in ((1, 3), (2, 7), (3, 7), (4, 1)) for i in range(n)]
    turns += [(5, i, *(talk[i] if i < 2 else ("user", "else"))) for i in range(4)]
    turns += [(6, 0, None, None), (6, 0, None, None), (6, None, "user", "<|end|>"), (None, 0, "user", "nobody")]
    turns += [(8, i, "user", str(i)) for i in range(2500)] + [(10, i, "user", str(i)) for i in range(1500)]
    table = spark.createDataFrame([(*t, "x") for t in turns], "conv_id bigint, turn bigint, role string, text string, place string")
    assert bag(map(tuple, chat.format_conversations(table.repartition(3)).collect())) == bag(brute_chat(turns))
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_registered_names():
    numbers = {int(re.match(r"op(\d+)_", n)[1]) for n in queries.registered()}
    assert numbers == set(range(1, 11))


def test_the_tokenizer_files_agree():
    """The ranks used for packing are the vocabulary of the JSON file."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    ranks = packing.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    letters = {b: chr(c) for b, c in tokens.byte_letters().items()}
    assert {"".join(letters[b] for b in token): rank for token, rank in ranks.items()} == vocabulary
