"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named by its smallest node.

    Each round hands the smallest node of a neighbourhood to its larger members, then to the smaller ones, so the number of
    rounds grows with the logarithm of the longest chain. Minima are combined before the shuffle; a node with very many edges
    is a skewed join key, which adaptive execution splits.
    """
    nodes = edges.select(F.col(a).alias("node")).unionAll(edges.select(F.col(b).alias("node"))).distinct()
    links = cut_lineage(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct())
    before = None
    while True:
        both = links.unionAll(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.min("low").alias("m")).withColumn("m", F.least("high", "m"))
        # The larger neighbours of a node, and the node itself, go to the smallest of the neighbourhood.
        wide = both.join(least, "high").where("low > high").select(F.col("low").alias("high"), F.col("m").alias("low")).distinct()
        wide = cut_lineage(wide)
        least = wide.groupBy("high").agg(F.min("low").alias("m"))
        near = wide.join(least, "high").where("low != m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        links = cut_lineage(near.unionAll(least.withColumnRenamed("m", "low")).distinct())
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    return nodes.join(links.withColumnRenamed("high", "node"), "node", "left").select("node", F.coalesce("low", "node").alias("component"))
