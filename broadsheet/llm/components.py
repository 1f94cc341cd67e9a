"""Connected components of links by alternating large and small stars, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: each node hands its smallest neighbour to its larger ones. Small star: to its smaller ones and itself."""
    flipped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = edges.union(flipped) if large else edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = around.join(least, "u")
    if large:
        return met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return met.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.where("u != m").select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the pairs in ``links``; the component is its smallest node.

    Rounds go on until a round changes nothing; their number grows with the logarithm of the longest chain. Joins on a node
    with very many links are plain joins that adaptive execution splits; minima are combined before the shuffle.
    """
    a, b = links.columns
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()

    def settled(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = store(edges, "links")
    before = settled(edges)
    while before[0]:
        edges = store(_star(store(_star(edges, True), "large-star"), False), "small-star")
        now = settled(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
