"""Ranking and neighbours inside groups of any size.

A window over a group puts the whole group into one task. When a group may hold a large share of all rows, the
functions here cut its ordering into segments first: rows are ranked inside (group, segment), and only one row per
segment is ranked across the group. ``segment`` must not decrease along the ordering, for example an hour for a
timestamp or an ordinal divided by a step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = "_segment"


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    cond = F.lit(True)
    for name in names:
        cond = cond & left[name].eqNullSafe(right[name])
    return cond


def _attach(df: DataFrame, side: DataFrame, names: list[str], how: str = "left") -> DataFrame:
    renamed = side
    for name in names:
        renamed = renamed.withColumnRenamed(name, f"_r_{name}")
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(name).eqNullSafe(F.col(f"_r_{name}"))
    return df.join(renamed, cond, how).drop(*[f"_r_{n}" for n in names])


def row_number(df: DataFrame, keys: list[str], segment: Column, order: list[Column], name: str = "rn") -> DataFrame:
    """``row_number`` per group without sorting a whole group in one task."""
    cut = df.withColumn(SEGMENT, segment)
    across = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, SEGMENT).agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(across), F.lit(0))).drop("_n")
    )
    inside = Window.partitionBy(*keys, SEGMENT).orderBy(*order)
    ranked = cut.withColumn(name, F.row_number().over(inside))
    return _attach(ranked, offsets, [*keys, SEGMENT]).withColumn(name, F.col(name) + F.col("_before")).drop("_before", SEGMENT)


def dense_rank(df: DataFrame, column: str, name: str = "rank", segment: Column | None = None) -> DataFrame:
    """Global ``dense_rank`` over a column: distinct values are ranked segment by segment and joined back."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    ranked = row_number(values, [], F.col(column) if segment is None else segment, [F.col(column)], name)
    return df.join(ranked, column, "left")


def neighbours(
    df: DataFrame, keys: list[str], segment: Column, order: list[Column], value: Column,
    previous: str | None = None, following: str | None = None,
) -> DataFrame:
    """``lag`` and ``lead`` of ``value`` per group, across segments as well."""
    cut = df.withColumn(SEGMENT, segment).withColumn("_v", value)
    inside = Window.partitionBy(*keys, SEGMENT).orderBy(*order)
    out = cut
    if previous:
        out = out.withColumn(previous, F.lag(F.struct("_v")).over(inside))
    if following:
        out = out.withColumn(following, F.lead(F.struct("_v")).over(inside))
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    edges = cut.groupBy(*keys, SEGMENT).agg(
        F.min_by(F.struct("_v"), place).alias("_first"), F.max_by(F.struct("_v"), place).alias("_last")
    )
    across = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(SEGMENT)
    edges = edges.select(
        *keys, SEGMENT, F.lag("_last").over(across).alias("_prev"), F.lead("_first").over(across).alias("_next")
    )
    out = _attach(out, edges, [*keys, SEGMENT])
    if previous:
        out = out.withColumn(previous, F.coalesce(F.col(previous), F.col("_prev"))["_v"])
    if following:
        out = out.withColumn(following, F.coalesce(F.col(following), F.col("_next"))["_v"])
    return out.drop("_prev", "_next", "_v", SEGMENT)


def value_at(df: DataFrame, keys: list[str], value: str, position: Column, segment: Column, name: str) -> DataFrame:
    """Value at a 0-based ascending position of each group; ``position`` may use the group size ``n``.

    Equal values are counted first, so a hot value is one row, and counts are summed per segment before they are
    summed along the group.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c")).withColumn(SEGMENT, segment)
    across = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(SEGMENT)
    totals = counts.groupBy(*keys, SEGMENT).agg(F.sum("_c").alias("_s"))
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    totals = (
        totals.withColumn("_before", F.sum("_s").over(across) - F.col("_s"))
        .withColumn("n", F.sum("_s").over(whole))
        .withColumn("_p", position.cast("long"))
        .where((F.col("_p") >= F.col("_before")) & (F.col("_p") < F.col("_before") + F.col("_s")))
        .drop("_s")
    )
    inside = Window.partitionBy(*keys, SEGMENT).orderBy(value)
    hit = (
        _attach(counts, totals, [*keys, SEGMENT], "inner")
        .withColumn("_upto", F.col("_before") + F.sum("_c").over(inside))
        .where((F.col("_upto") > F.col("_p")) & (F.col("_upto") - F.col("_c") <= F.col("_p")))
    )
    return hit.select(*keys, F.col(value).alias(name), "n")
