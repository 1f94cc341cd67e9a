"""SO1-SO5: set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(*frames: DataFrame) -> DataFrame:
    """SO1. Union of sources with different columns; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def removed_keys(previous: DataFrame, current: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """SO2. Removed keys, marked as allowed or unexpected."""
    gone = previous.select(key).distinct().join(current.select(key), key, "left_anti")
    permitted = allowed.select(F.col(key).alias("_k")).distinct()
    marked = gone.join(permitted, gone[key] == permitted["_k"], "left")
    return marked.select(key, F.when(F.col("_k").isNotNull(), "allowed").otherwise("unexpected").alias("verdict"))


def shared_values(left: DataFrame, right: DataFrame) -> DataFrame:
    """SO3. Row-level intersection."""
    return left.intersect(right)


def distinct_union(*frames: DataFrame) -> DataFrame:
    """SO4."""
    return reduce(lambda a, b: a.union(b), frames).distinct()


def union_tasks(*frames: DataFrame) -> DataFrame:
    """SO5. One queue from all builders."""
    return union_sources(*frames)


def queue_order() -> list:
    return [F.col("priority").desc(), F.col("indexable").desc(), F.col("title"), F.col("id")]
