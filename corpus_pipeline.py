"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet in the shared folder and read
again as the next stage's docs. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from broadsheet.llm import exact, ngram_join, packing, quality, substrings
from broadsheet.llm.base import discard, store, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules or the base rule reject go."""
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest stays, then the one with the smallest id."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more: one document of each linked group stays."""
    return ngram_join.keep_one(docs, n=5, least=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a 13-word window that also starts in a document with a smaller id go."""
    return substrings.cut_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_join", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Estimation by expectation-maximisation, byte-pair merges and packing have no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
