"""WN1-WN11: ranking, streaks and neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import segments


def capped_pick(df: DataFrame, source: str, order: list[Column], per_source: int, limit: int) -> DataFrame:
    """WN1. At most ``per_source`` rows per source, then the best ``limit`` overall; equals a greedy scan by score."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(source).orderBy(*order))).where(F.col("_rn") <= per_source)
    return ranked.drop("_rn").orderBy(*order).limit(limit)


def round_robin(df: DataFrame, group: str, group_ord: str, segment: Column, order: list[Column]) -> DataFrame:
    """WN2. Position of each row when the groups are drawn in turn."""
    turned = segments.row_number(df, [group], segment, order, "turn")
    return turned.withColumn("draw_key", F.struct("turn", group_ord))


def average_gap(df: DataFrame, key: str, ts: str) -> DataFrame:
    """WN3. Mean distance of consecutive dates in days: (newest - oldest) / (n - 1)."""
    grouped = df.where(F.col(ts).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    gap = (F.unix_micros("_hi") - F.unix_micros("_lo")) / F.lit(86400000000.0) / (F.col("n") - 1)
    return grouped.select(key, "n", F.when(F.col("n") >= 2, F.round(gap, 2)).alias("average_gap_days"))


def success_streak(runs: DataFrame, key: str, order: str, success: str, cap: int = 20) -> DataFrame:
    """WN4. Successful runs since the last failure, at most ``cap``. Two aggregations, no ordering of a key's history."""
    failures = runs.where(~F.col(success)).groupBy(key).agg(F.max(order).alias("_failed"))
    after = runs.join(failures, key, "left").groupBy(key).agg(
        F.count_if(F.col(success) & (F.col("_failed").isNull() | (F.col(order) > F.col("_failed")))).alias("_n")
    )
    return after.select(key, F.least(F.col("_n"), F.lit(cap)).alias("consecutive_successes"))


def last_runs_ok(runs: DataFrame, key: str, order: list[Column], success: str, needed: int = 3) -> DataFrame:
    """WN6. Whether each of the last runs was a success, and there were that many."""
    recent = runs.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_rn") <= needed)
    return recent.groupBy(key).agg((F.bool_and(success) & (F.count("*") >= needed)).alias("all_ok"), F.count("*").alias("runs"))


def edition_rank(df: DataFrame, day: str) -> DataFrame:
    """WN7. Number of the edition, the oldest is 1. Only the different days are ranked."""
    return segments.dense_rank(df, day, "edition", F.year(day))


def edition_neighbours(df: DataFrame, edition: str, ordinal: str, item: str, step: int = 1000) -> DataFrame:
    """WN8. Previous and next item of an edition."""
    segment = F.floor(F.col(ordinal) / F.lit(step))
    return segments.neighbours(df, [edition], segment, [F.col(ordinal)], F.col(item), "prev_id", "next_id")


def daily_fill(candidates: DataFrame, existing: DataFrame, day: str, order: list[Column], target: int) -> tuple[DataFrame, DataFrame]:
    """WN9. Candidates that fill each day up to its target, and the shortfall that stays."""
    have = existing.groupBy(day).agg(F.count("*").alias("_have"))
    ranked = candidates.withColumn("_rn", F.row_number().over(Window.partitionBy(day).orderBy(*order))).where(F.col("_rn") <= target)
    joined = ranked.join(have, day, "left").withColumn("_have", F.coalesce("_have", F.lit(0)))
    picked = joined.where(F.col("_rn") <= F.greatest(F.lit(0), F.lit(target) - F.col("_have"))).drop("_have")
    counts = picked.groupBy(day).agg(F.count("*").alias("_new")).join(have, day, "full_outer")
    total = F.coalesce("_new", F.lit(0)) + F.coalesce("_have", F.lit(0))
    shortfall = counts.select(day, F.coalesce("_new", F.lit(0)).alias("released"), F.greatest(F.lit(0), F.lit(target) - total).alias("shortfall"))
    return picked.withColumnRenamed("_rn", "release_rank"), shortfall


def disambiguate_titles(df: DataFrame, title: str, day: str, item: str) -> DataFrame:
    """WN10. Page title with the item id where title and date are not unique."""
    key = F.concat(F.col(title), F.lit(" · "), F.col(day).cast("string"))
    keyed = df.withColumn("_key", key)
    shared = keyed.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1").select("_key", F.lit(True).alias("_many"))
    out = keyed.join(shared, "_key", "left")
    return out.withColumn("page_title", F.when(F.col("_many"), F.concat("_key", F.lit(" · "), F.col(item).cast("string"))).otherwise(F.col("_key"))).drop("_many", "_key")


def mark_deep(df: DataFrame, row: str, order: list[Column], k: int) -> DataFrame:
    """WN11. Flag the first ``k`` rows of the list."""
    top = df.orderBy(*order).limit(k).select(F.col(row).alias("_row"), F.lit(True).alias("_deep"))
    return df.join(top, df[row] == top["_row"], "left").withColumn("deep", F.coalesce("_deep", F.lit(False))).drop("_row", "_deep")
