"""A training corpus from documents: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from changetide.llm import packing, quality, repeats, simhash, toxicity
from changetide.llm.common import stored, table
from changetide.llm.queries import PACKING


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the classifier does not call toxic. It learns from `docs` and `labels`."""
    score = toxicity.scorer(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return docs.where(score(F.coalesce("text", F.lit(""))) < 0.5)


def drop_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their hosts' common lines; `n_chars` follows the text."""
    return quality.clean_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of SimHash near-duplicates."""
    return simhash.keep_one(docs, shingle=4, bits=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that start earlier; `n_chars` follows the text.

    A document of which nothing is left stays, with an empty text.
    """
    return repeats.cut_documents(docs, match=100)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs, **PACKING)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_junk),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("best_fit_packing", pack),
]

#: Hashing, learning and packing have no SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), name)
    return docs
