"""DD1-DD10: duplicate handling."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import compact
from ..session import cut_lineage, shared_folder
from .components import connected
from .segments import neighbours


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key. Spark keeps one row per key and partition before the shuffle (window group limit)."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def keep_first_by_keys(df: DataFrame, row: str, ordinal: str, keys: Column, rounds: int = 4, component_claims: int = 1_000_000) -> DataFrame:
    """DD1. Greedy first-wins over several keys; a dropped row does not claim its keys.

    Row ``b`` is kept if and only if no kept row before it shares a key. Each round keeps the undecided rows that come first on
    all of their keys and drops the rows that share a key with them, so the result equals the sequential scan; hot keys and
    small groups are decided in the first few. What is left after ``rounds`` depends on long chains: it is split into connected
    components, components of at most ``component_claims`` (row, key) pairs are scanned in order, many in one task, and larger
    ones go on in rounds, however many that takes. ``ordinal`` must be unique. Rows without keys are kept.
    """
    base = df.select(F.col(row).alias("_row"), F.col(ordinal).alias("_ord"), keys.alias("_keys"))
    claims = cut_lineage(base.select("_row", "_ord", F.explode("_keys").alias("_key")))
    # A key held by one row decides nothing; dropping it here keeps the rounds to rows that do collide.
    shared = claims.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1").select("_key")
    open_claims = cut_lineage(claims.join(shared, "_key", "left_semi"))
    if open_claims.isEmpty():
        return df
    path = shared_folder(df.sparkSession, "dropped-rows")  # one table of all rows that fall

    def drop(losers: DataFrame) -> None:
        losers.write.mode("append").parquet(path)

    drop(open_claims.select("_row").limit(0))
    while not open_claims.isEmpty():
        for _ in range(rounds):
            open_claims = _decide_firsts(open_claims, drop)
            if open_claims.isEmpty():
                break
        else:
            parts = cut_lineage(connected(open_claims.join(open_claims.groupBy("_key").agg(F.min("_row").alias("_first")), "_key"), "_row", "_first"))
            placed = cut_lineage(open_claims.join(parts.select(F.col("node").alias("_row"), "component"), "_row"))
            small = placed.groupBy("component").agg(F.count("*").alias("_n")).where(F.col("_n") <= component_claims).select("component")
            drop(_scan_components(placed.join(small, "component", "left_semi")))
            open_claims = cut_lineage(placed.join(small, "component", "left_anti").select("_row", "_ord", "_key"))
            rounds *= 2  # components are sought again less and less often
    dropped = df.sparkSession.read.schema(open_claims.select("_row").schema).parquet(path)
    return df.join(dropped.withColumnRenamed("_row", row), row, "left_anti")


def _decide_firsts(open_claims: DataFrame, drop: Callable[[DataFrame], None]) -> DataFrame:
    """Claims that are still open after one round; the rows that fall are handed to ``drop``."""
    firsts = open_claims.groupBy("_key").agg(F.min("_ord").alias("_first"))
    marked = open_claims.join(firsts, "_key").withColumn("_lost", (F.col("_first") < F.col("_ord")).cast("int"))
    kept = cut_lineage(marked.groupBy("_row").agg(F.max("_lost").alias("_any")).where("_any = 0").select("_row"))
    taken = open_claims.join(kept, "_row", "left_semi").select("_key").distinct()
    losers = cut_lineage(open_claims.join(taken, "_key", "left_semi").join(kept, "_row", "left_anti").select("_row").distinct())
    drop(losers)
    return cut_lineage(open_claims.join(losers.unionByName(kept), "_row", "left_anti"))


def _scan_components(placed: DataFrame) -> DataFrame:
    """Rows (_row) that fall in the sequential scan of each component; a task holds the keys of one component at a time."""

    def run(batches):
        component, row, own, seen = None, None, set(), set()
        for batch in batches:
            fallen = []
            for c, r, k in zip(*[column.to_pylist() for column in batch.columns]):
                if r != row or c != component:
                    if own & seen:
                        fallen.append(row)
                    else:
                        seen |= own
                    if c != component:
                        component, seen = c, set()
                    row, own = r, set()
                own.add(k)
            yield pa.RecordBatch.from_arrays([pa.array(fallen, batch.column(1).type)], names=["_row"])
        if own & seen:
            yield pa.RecordBatch.from_arrays([pa.array([row], batch.column(1).type)], names=["_row"])

    kind = placed.schema["_row"].dataType.simpleString()
    ordered = placed.repartition("component").sortWithinPartitions("component", "_ord", "_row").select("component", "_row", "_key")
    return ordered.mapInArrow(run, f"_row {kind}")


def latest_earlier_holder(claims: DataFrame, key: str, ordinal: str, holder: str, step: int = 1000) -> DataFrame:
    """DD2. For each claim, the holder of the same key that came last before it (null if there is none)."""
    segment = F.floor(F.col(ordinal) / F.lit(step))
    return neighbours(claims, [key], segment, [F.col(ordinal)], F.struct(F.col(ordinal).alias("ord"), F.col(holder).alias("id")), previous="prior")


def flag_later_copies(df: DataFrame, key: str, order: list[Column], name: str = "duplicate_source") -> DataFrame:
    """DD4. True on every row after the first of its key. The first is found by aggregation, not by sorting the group."""
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    keyed = df.withColumn("_place", place)
    firsts = keyed.where(F.col(key) != "").groupBy(key).agg(F.min("_place").alias("_first"))
    flagged = keyed.join(firsts, key, "left")
    return flagged.withColumn(name, F.coalesce(F.col("_first") != F.col("_place"), F.lit(False))).drop("_first", "_place")


def first_by_prefix(df: DataFrame, value: str, order: list[Column], chars: int, limit: int) -> DataFrame:
    """DD5. First row per text prefix, then the first ``limit`` rows."""
    keyed = df.withColumn("_prefix", F.substring(value, 1, chars)).where(F.col("_prefix") != "")
    return first_per_key(keyed, ["_prefix"], order).orderBy(*order).limit(limit).drop("_prefix")


def clear_repeated(df: DataFrame, key: str, column: str, minimum: int = 2) -> DataFrame:
    """DD6. Null ``column`` wherever its key occurs ``minimum`` times or more."""
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") >= minimum)
    marked = df.join(repeated.select(key, F.lit(True).alias("_repeated")), key, "left")
    return marked.withColumn(column, F.when(F.col("_repeated"), F.lit(None)).otherwise(F.col(column))).drop("_repeated")


def repeated_values(df: DataFrame, row: str, values: dict[str, Column]) -> DataFrame:
    """DD7. (field, value, rows, first row) for each value used by more than one row; one pass for all fields."""
    entries = F.array(*[F.struct(F.lit(f).alias("field"), c.alias("value")) for f, c in values.items()])
    long = df.select(row, F.explode(entries).alias("e")).select(row, "e.field", "e.value").where(F.col("value") != "")
    grouped = long.groupBy("field", "value").agg(F.count("*").alias("n_rows"), F.min(row).alias("first_row"))
    return grouped.where("n_rows > 1").withColumn(
        "severity", F.when(F.col("field") == "canonical", "critical").otherwise("warning")
    )


def has_repeated_paragraph(parts: Column) -> Column:
    """DD8."""
    plain = F.transform(parts, compact)
    return F.size(F.array_distinct(plain)) < F.size(plain)


def repeated_across(df: DataFrame, value: str, holder: str, order: list[Column]) -> DataFrame:
    """DD9. Every later holder of a value together with the first one."""
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    keyed = df.where(F.col(value) != "").withColumn("_place", place)
    firsts = keyed.groupBy(value).agg(F.min("_place").alias("_first"), F.min_by(holder, "_place").alias("first_holder"))
    return keyed.join(firsts, value).where(F.col("_place") != F.col("_first")).drop("_place", "_first")


def restore_seen(seen: DataFrame, key: str, retry_keys: DataFrame) -> DataFrame:
    """DD10. Seen keys without those to be retried."""
    return seen.join(retry_keys, key, "left_anti")
