"""One query per operator, applied to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from changetide.llm import chat, classifier, fingerprints, merkle, packing, pieces, quality, repeats, simhash, tokens, toxicity, trie, warc
from changetide.llm.common import table

#: The vocabulary of byte_bpe_50k.json in the form that is fastest to encode with.
PACKING = {
    "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    "pattern": public_tokenizers.PATTERN,
    "special": {"<|endoftext|>": 50256},
}


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.segment(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), best=3)


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), **PACKING)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_spans(table(spark, sf_dir, "documents"), match=100)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.dataset_manifest(table(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie_nodes(table(spark, sf_dir, "conversations"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_token_counts, op2_simhash_near_dedup, op3_quality_rules, op4_sentencepiece, op5_document_fingerprints, op6_best_fit_packing, op7_warc, op8_suffix_array_dedup, op9_toxicity, op10_chat_formatting, op11_merkle_manifest, op12_quality_classifier, op13_prefix_trie]
    return {f.__name__: f for f in found}
