"""Bounded samples of labelled documents, drawn by a hash of the id so that every run draws the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(doc_id, divisor: int):
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def labelled(docs: DataFrame, labels: DataFrame, label: str, training, size: int) -> DataFrame:
    """(doc_id, text, label) of at most ``size`` rows of each class among the ids that ``training`` selects, by a hash of the id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
    known = known.where(training(F.col("doc_id")))
    drawn = [known.where(F.col(label) == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for c in (0, 1)]
    return docs.join(F.broadcast(drawn[0].union(drawn[1])), "doc_id")
