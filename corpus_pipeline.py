"""A corpus pipeline: quality filter, near-dedup, substring dedup, decontamination, tokens.

``run`` applies the stages to ``documents``; each stage's rows are written to the shared folder and
read again, so a lost executor costs no more than the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from periodbook.llm import bpe, decontaminate, near_dedup, quality, substring_dedup
from periodbook.llm.common import keep, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.keep_one(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out."""
    return substring_dedup.cut(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the texts that are left; ids and texts are checked by decoding."""
    return bpe.digests(docs, bpe.vocabulary_text())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding_and_decoding", bpe_tokens),
]
# Trained and hashed stages: SQL cannot say them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
