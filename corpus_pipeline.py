"""The corpus pipeline: stages over ``documents``, each on all that its predecessor kept.

Language identification drops the documents it rejects, exact and near deduplication
keep one document of each group, decontamination drops the documents in which a
benchmark passage occurs, and packing lays what is left into token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm import decontaminate, exact_dedup, jaccard_join, language_id, packing
from framewell.llm.common import read_table
from framewell.llm.queries import language_model, tokenizer_file
from framewell.plans.settle import settle


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled ones."""
    return language_id.keep_known(docs, language_model(docs))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.deduplicate(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents tied by near copies (five words, 0.8) the one with the smallest id."""
    return jaccard_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of 4096 tokens, each window mixed by source."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# The language model and the tokenizer are beyond SQL; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = settle(docs, name)
    return docs
