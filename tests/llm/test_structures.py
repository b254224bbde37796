"""Manifest, quality classifier and prefix trie against brute force, on small and odd tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changetide.llm import classifier, merkle, order, packing, queries, tokens, trie, warc
from changetide.llm.common import table

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, node string, place int, proof string, _part int"
TURNS = "conv_id bigint, turn bigint, role string, text string, least bigint, place bigint, a bigint"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    """Each level of each tree as a list; proofs and folds follow the indices."""

    def shown(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(r, more=0):
        return digest(*map(shown, (r[0], r[1], r[2], None if r[3] is None else r[3] + more, r[4])))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
        return levels

    def path(levels, i):
        for level in levels[:-1]:
            yield (level[i ^ 1], i % 2) if i ^ 1 < len(level) else None
            i //= 2

    parts = sorted({r[2] for r in rows}, key=lambda p: (p is not None, (p or "").encode()))
    leaves = {p: sorted((r[0] is not None, r[0] or 0, leaf(r), r[:5]) for r in rows if r[2] == p) for p in parts}
    trees = {p: tree([x[2] for x in leaves[p]]) for p in parts}
    crown = tree([trees[p][-1][0] for p in parts])
    found = []
    for k, p in enumerate(parts):
        for i, (_, _, node, r) in enumerate(leaves[p]):
            steps = [*path(trees[p], i), *path(crown, k)]
            folded = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)
            for s in steps:
                folded = digest(folded) if s is None else digest(s[0], folded) if s[1] else digest(folded, s[0])
            proof = digest(*(s[0] for s in steps if s))
            found.append((r[0], node, trees[p][-1][0], crown[-1][0], proof, folded, folded == crown[-1][0]))
    return sorted(map(repr, found))


def manifest_rows(counts):
    rng = random.Random(5)
    for lang, n in counts.items():
        for i in range(n):
            yield (rng.choice([i, i, None]), rng.choice(["s", None]), lang, rng.choice([3, None]), rng.choice(["é", "", None, "t" * i]), "n", 1, "p", 2)


@pytest.mark.parametrize("counts", [{"en": 1}, {"en": 300, None: 1, "": 2, "zü": 257, "z": 3, "c": 513}, {None: 256}])
def test_manifest(spark, counts):
    rows = list(manifest_rows(counts))
    rows += rows[:3]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert sorted(map(repr, map(tuple, merkle.dataset_manifest(docs).collect()))) == brute_manifest(rows)


def test_manifest_of_nothing(spark):
    assert merkle.dataset_manifest(spark.createDataFrame([], DOCS)).count() == 0


def test_strata_of_many_levels(spark):
    """Three strata: 70,000 leaves of one tree are more than two levels of subtrees of 256 hold."""
    leaves = spark.range(70_000).select(F.lit(None).cast("string").alias("part"), "id", F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    proved = merkle.prove_rows(leaves)
    level = [digest(str(i)) for i in range(70_000)]
    while len(level) > 1:
        level = [digest(*level[i : i + 2]) for i in range(0, len(level), 2)]
    told = proved.select("subroot", "root", merkle.fold(F.col("leaf"), F.col("proof")).alias("folded"), F.size("proof").alias("steps"))
    assert [tuple(r) for r in told.distinct().collect()] == [(level[0], level[0], level[0], 17)]


def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tid = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, tid, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends, kids = {}, {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = tuple(own.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
        ends.setdefault(whole, []).append(c)
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids.get(node, []))
        leaves[node] = sum(leaves[k] for k in kids.get(node, [])) or 1
    return sorted(
        repr((
            min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids.get(n, [])), leaves[n], saved[n],
            digest(",".join(map(str, sorted(ends.get(n, []))))),
        ))
        for n, m in members.items()
    )


TRIE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module")
def odd_turns(spark):
    """Copies, snapshots, null and repeated turns, negative ids, a conversation without an id, clashing columns."""
    rng = random.Random(3)
    rows = []
    for c in [*range(-45, 60), 1_000_003]:
        for t in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([None, t, t]), rng.choice(["u", "a", None]), rng.choice(["x", "y z\n", None, ""])))
    for c in range(2000, 2200):  # most of them are copies, or begin alike
        rows += [(c, t, "u", f"turn {t}") for t in range(6 + c % 3)]
    rows += [(None, 1, "u", "x"), (7, None, None, None)] * 3
    rows += [(5000, t, "u", "word " * (t % 5)) for t in range(300)]
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURNS).repartition(3).cache()


@pytest.mark.parametrize("limit", [1, 50, trie.LIMIT])
def test_trie(odd_turns, limit):
    want = brute_trie([tuple(r)[:4] for r in odd_turns.collect()])
    got = trie.trie_nodes(odd_turns, limit).select(*TRIE_COLUMNS).collect()
    assert sorted(map(repr, map(tuple, got))) == want


def test_trie_of_nothing(spark):
    assert trie.trie_nodes(spark.createDataFrame([], TURNS)).count() == 0


def test_trie_of_conversations_without_turns(spark):
    """Conversation 22 lends nothing from 20, which is not there, and loses its own first turn."""
    assert zlib.crc32(b"22") % 4 > 0
    rows = [(22, 0, "u", "x")]
    got = trie.trie_nodes(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert sorted(map(repr, map(tuple, got.select(*TRIE_COLUMNS).collect()))) == brute_trie(rows) and got.count() == 1


def test_running_values_over_blocks(spark):
    rows = spark.range(10_000).select(F.lit(1).alias("k"), "id", (F.col("id") % 7).alias("v"))
    got = {r.id: (r.v_before, r.v_all) for r in order.running(rows, "k", "id", ["v"], "sum").collect()}
    values = [i % 7 for i in range(10_000)]
    assert got == {i: (sum(values[:i]), sum(values)) for i in range(0, 10_000)}


def test_equal_rows_have_places_of_their_own(spark):
    rows = spark.range(5_000).select(F.lit(None).cast("string").alias("k"), F.lit(1).alias("v"))
    places, _ = order.placed(rows.repartition(5), ["k"], ["v"], "test")
    assert sorted(r.place for r in places.collect()) == list(range(5_000)) and {r.size for r in places.collect()} == {5_000}


def test_statistics_of_blocks(monkeypatch):
    text = "alpha beta gamma, DELTA 12!\n\nalpha alpha http://x.y/z é漢 " * 50
    whole = classifier.block_counts(text)
    assert whole[0] == 450 and whole[1] == len(text) and len(classifier.statistics(text)) == len(classifier.NAMES)
    assert len(classifier.statistics("")) == len(classifier.NAMES) and np.isfinite(classifier.statistics("")).all()
    monkeypatch.setattr(classifier, "BLOCK", 100)
    parts = list(classifier.blocks(text))
    assert "".join(parts) == text and len(parts) > 20
    added = sum(classifier.block_counts(p) for p in parts)
    assert (added[:6] == whole[:6]).all()  # words and characters do not depend on where a block ends
    assert "".join(classifier.blocks("x" * 1_000)) == "x" * 1_000


def test_a_text_of_millions_of_characters():
    assert np.isfinite(classifier.statistics("lorem ipsum\n" * 300_000)).all() and np.isfinite(classifier.statistics(" " * 3_000_000)).all()


def test_rising_shares():
    """Against the least-squares rising fit by its min-max formula."""
    rng = np.random.default_rng(4)
    shares, counts = rng.random(40), rng.integers(1, 9, 40).astype(float)
    places, fitted = classifier.rising(np.arange(40.0), shares, counts)
    mean = lambda i, j: np.average(shares[i : j + 1], weights=counts[i : j + 1])
    want = [max(min(mean(i, j) for j in range(k, 40)) for i in range(k + 1)) for k in range(40)]
    assert (np.diff(fitted) > 0).all() and (np.diff(places) > 0).all()
    assert np.allclose(np.unique(np.round(want, 9)), np.round(fitted, 9))


def test_normal_equations_are_the_sums_of_all_rows(spark):
    rng = np.random.default_rng(6)
    stats, y = rng.normal(size=(300, len(classifier.NAMES))), rng.integers(0, 2, 300)
    rows = [(list(map(float, s)), int(v), i % 4) for i, (s, v) in enumerate(zip(stats, y, strict=True))]
    training = spark.createDataFrame(rows, "stats array<double>, y int, fold int").repartition(7)
    fourier = classifier.fit_fourier(training, 16, 1.0, 1)
    got = classifier.normal_equations(training, fourier)
    for fold in range(4):
        z = fourier(stats[fold::4])
        assert np.allclose(got[fold], z.T @ np.column_stack([z, y[fold::4]]))


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(8)
    size, features = len(classifier.NAMES), 20_000
    x = rng.normal(size=(6, size))
    fourier = classifier.Fourier(np.zeros(size), np.ones(size), rng.normal(size=(size, features)) / np.sqrt(size), rng.uniform(0, 2 * np.pi, features))
    z = fourier(x)[:, :features]
    kernel = np.exp(-((x[:, None] - x) ** 2).sum(-1) / (2 * size))
    assert np.abs(z @ z.T - kernel).max() < 0.05


def quality(docs, labels):
    return {r.doc_id: r for r in classifier.score_quality(docs, labels).collect()}


def test_held_out_accuracy(spark):
    folder = FOLDER.replace("0.001", "0.1")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    found = quality(docs, labels)
    assert len(found) == docs.count()
    told = [(r.quality, found[r.doc_id]) for r in labels.collect() if found[r.doc_id].held_out]
    assert all(s.held_out == (zlib.crc32(str(s.doc_id).encode()) % 5 == 0) for _, s in told)
    right = sum(q == s.predicted for q, s in told)
    brier = np.mean([(q - s.score) ** 2 for q, s in told])
    assert len(told) > 700 and right / len(told) > 0.985 and brier < 0.01


def test_only_texts_and_training_labels_count(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    scores = {i: r.score for i, r in quality(docs, labels).items()}
    turned = labels.withColumn("quality", F.when(classifier.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0)})
    again = {i: r.score for i, r in quality(other.repartition(3), turned.unionByName(turned)).items()}
    assert all(abs(again[i] - s) < 1e-6 for i, s in scores.items())


def test_odd_documents_and_labels(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "x y", "b"), (3, "", None), (4, "z " * 99, "")], "doc_id bigint, text string, stats string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = classifier.score_quality(docs, none).collect()
    assert len(rows) == 5 and {r.score for r in rows} == {0.5} and {r.predicted for r in rows} == {1}
    one = spark.createDataFrame([(1, 1, 0), (3, None, 0), (None, 0, 0), (4, 5, 0)], none.schema)
    assert {r.score for r in classifier.score_quality(docs, one).collect()} == {2.5 / 3}
    two = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (4, 0, 0), (4, 0, 1)], none.schema)
    scored = classifier.score_quality(docs, two).collect()
    assert len(scored) == 5 and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id in (1, 3)}) == 1 and not [r for r in scored if r.doc_id is None][0].held_out
    assert classifier.score_quality(docs.limit(0), two).count() == 0


def test_archive_reader_is_linear(tmp_path, monkeypatch):
    """Twice the records in one range are twice the bytes given to the inflater, and no more than a piece each."""
    fed = []

    class Counted:
        def __init__(self, *options):
            self.inner = zlib.decompressobj(*options)

        def decompress(self, data, *most):
            fed[-1] += len(data)
            return self.inner.decompress(data, *most)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    class Zlib:
        error, decompressobj = zlib.error, Counted

    monkeypatch.setattr(warc, "zlib", Zlib)
    rng, sizes = random.Random(2), []
    for n in (300, 600):
        path = tmp_path / f"{n}.warc.gz"
        bodies = [f"WARC/1.1\r\n\r\n{i} {rng.random()}".encode() * rng.choice([1, 9]) for i in range(n)]
        path.write_bytes(b"".join(zlib.compress(b, 6, 31) for b in bodies))
        sizes.append(path.stat().st_size)
        fed.append(0)
        assert [c for _, c in warc.records(str(path), 0, sizes[-1])] == bodies
    assert fed[1] < 2.2 * fed[0] and fed[1] <= 600 * warc.FIRST


def test_a_record_longer_than_the_window(tmp_path):
    body = b"WARC/1.1\r\n\r\n" + np.random.default_rng(3).bytes(900_000)
    path = tmp_path / "long.warc.gz"
    path.write_bytes(zlib.compress(body, 1, 31) + zlib.compress(b"WARC/1.1 next", 1, 31))
    assert [c for _, c in warc.records(str(path), 0, 50)] == [body]
    assert [c for _, c in warc.records(str(path), 50, path.stat().st_size)] == [b"WARC/1.1 next"]


@pytest.mark.parametrize("text", [
    "a" + " " * 2_000_000 + "b", "\n" * 2_000_000, "x " + " \t\u2003" * 400_000 + "<|endoftext|> y", "k" * 2_000_000, "a  b" + "\r\n" * 9_000 + " " * 10_001 + "\n7",
])
def test_packing_encodes_very_long_runs(text):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    options = queries.PACKING
    encode = packing.Encoder(packing.load_ranks(options["ranks"]), options["pattern"], options["special"])
    assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_counting_marks_and_random_texts():
    """Marks behind letters that change in lower case, and random texts of odd characters, as the library counts them."""
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    counter, library = tokens.WordCounter(definition, tokens.whole_tokens(definition), tokens.stable_characters()), Tokenizer.from_file(path)
    marks = ["\u05b1", "\u0327", "\u0316", "\u0301", "\u0345", "\u0e38"]
    cases = [f"x {a}{m}{n} İstanbul y" for a in "İIiſÅΣςǅ" for m in marks for n in marks]
    rng = random.Random(9)
    alphabet = "İIiΣσς aB'’1 .\n\u200d" + "".join(marks) + "éÉßẞĳǆ漢字한ᄒ\u1161\u11ab\u0958\u212b"
    cases += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    want = [len(e.ids) for e in library.encode_batch(cases, add_special_tokens=False)]
    wrong = [(c, counter.count(c), w) for c, w in zip(cases, want, strict=True) if counter.count(c) != w]
    assert not wrong
