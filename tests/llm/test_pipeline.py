"""The pipeline: each stage's decisions on its own input, against brute force."""

import pytest

import corpus_pipeline
from changetide.llm import quality, queries, simhash, toxicity
from changetide.llm.common import stored, table
from test_operators import assert_sequences, bag, brute_repeats

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = table(spark, FOLDER, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs, _ = stored(stage(spark, docs, FOLDER), name)
        found.append(docs)
    return found


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_columns(results):
    assert all(r.columns == results[0].columns for r in results[:5])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]


def test_filters_keep_what_their_operator_says(spark, results):
    scored = toxicity.score_toxicity(results[0], table(spark, FOLDER, "labels"))
    assert ids(results[1]) == ids(scored.where("predicted = 0"))
    assert ids(results[2]) == ids(quality.quality_rules(results[1]).where("kept"))
    assert ids(results[3]) == ids(simhash.near_duplicates(results[2]).where("component_id = doc_id"))
    assert len(ids(results[3])) < len(ids(results[2])) < len(ids(results[1])) < len(ids(results[0]))


def test_repeats_are_cut(results):
    rows = [(r.doc_id, r.text) for r in results[3].collect()]
    want = {rows[n][0]: kept.decode(errors="ignore") for n, (_, _, _, kept) in brute_repeats(rows, 100).items()}
    assert {r.doc_id: r.text for r in results[4].collect()} == want


def test_packed_pieces(spark, results):
    rows = results[5].collect()
    assert_sequences(rows, 1024)
    assert {r.doc_id for r in rows} == set(ids(results[4]))


def test_run_is_the_stages(spark, results):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = corpus_pipeline.run(spark, FOLDER)
    assert bag(run.select(*columns).collect()) == bag(results[5].select(*columns).collect())


@pytest.mark.parametrize("name", list(queries.registered()))
def test_queries_run_on_their_whole_table(spark, name):
    result = queries.registered()[name](spark, FOLDER)
    whole = table(spark, FOLDER, "pages" if name.startswith("op7") else "documents").count()
    rows = result.count()
    assert rows >= whole if name.startswith("op6") else rows == whole or name.startswith(("op10", "op13"))
