"""FL11 over SK3: substring search that reads an index by month instead of every text.

The index has, per month, the three-letter grams of the searched texts with the entries that hold them: a row per gram and block
of 64 entries, with a bit per entry. A search reads the grams of its needle only, intersects them, and reads chunks of the
months that are left; the substring itself is tested on the candidates alone. Common grams cost a row per 64 entries, and no
list of (gram, entry) pairs is stored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .coverage import BLOCK, grams

SIZE = 3


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(gram), F.lit(buckets)).cast("int")


def write_index(entries: DataFrame, ordinal: str, month: str, fields: list[str], path: str, buckets: int = 16) -> None:
    """SK3. Write ``entries`` as monthly chunks and the postings of their ``fields`` under ``path``. ``ordinal`` is a whole number that
    no two entries share; entries without a month form a chunk of their own. Rows are not gathered by month, so a hot month is
    written by many tasks."""
    text = F.lower(F.concat_ws(" ", *fields))
    rows = entries.withColumns({"_text": text, "_block": F.floor(F.col(ordinal) / BLOCK)})
    rows.sortWithinPartitions(month, ordinal).write.mode("overwrite").partitionBy(month).parquet(f"{path}/chunks")
    # The entries of a block meet before they are cut into grams, so that texts are shuffled once and no grams are.
    texts = entries.sparkSession.read.parquet(f"{path}/chunks").select(month, "_block", F.col(ordinal).cast("long").alias("_ord"), "_text").repartition("_block")
    held = texts.select(month, "_block", "_ord", F.explode(grams(F.col("_text"), SIZE)).alias("gram"))
    bit = F.expr(f"shiftleft(1L, CAST(pmod(_ord, {BLOCK}) AS INT))")
    postings = held.groupBy(month, "gram", "_block").agg(F.bit_or(bit).alias("mask")).withColumn("bucket", _bucket(F.col("gram"), buckets))
    postings.sortWithinPartitions(month, "bucket", "gram").write.mode("overwrite").partitionBy(month, "bucket").parquet(f"{path}/postings")
    entries.sparkSession.createDataFrame([(month, ordinal, buckets)], "month string, ordinal string, buckets int").write.mode("overwrite").parquet(f"{path}/about")


def candidates(spark: SparkSession, path: str, needle: str) -> DataFrame | None:
    """(month, _block, mask) of the entries that hold all grams of the needle; None where it is too short to have any."""
    about = spark.read.parquet(f"{path}/about").first()
    wanted = sorted({needle[i : i + SIZE] for i in range(len(needle) - SIZE + 1)})
    if not wanted:
        return None
    places = sorted({zlib.crc32(g.encode()) % about["buckets"] for g in wanted})
    postings = spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(places) & F.col("gram").isin(wanted))
    return postings.groupBy(about["month"], "_block").agg(F.bit_and("mask").alias("mask"), F.count("*").alias("n")).where((F.col("n") == len(wanted)) & (F.col("mask") != 0)).drop("n")


def search_index(spark: SparkSession, path: str, query: str, category: str | None = None, read_ids: DataFrame | None = None, row: str | None = None) -> DataFrame:
    """FL11. Entries whose fields contain the query, of one category and unread where that is asked for: the rows of
    ``filters.search``, read through the index."""
    about = spark.read.parquet(f"{path}/about").first()
    month, ordinal = about["month"], about["ordinal"]
    needle = query.strip().lower()
    out = spark.read.parquet(f"{path}/chunks")
    if needle:
        found = candidates(spark, path, needle)
        if found is not None:
            found = found.select(F.col(month).alias("_m"), F.col("_block").alias("_b"), "mask")
            months = [r[0] for r in found.select("_m").distinct().collect()]  # one value per month
            here = F.col(month).isin([m for m in months if m is not None]) | (F.col(month).isNull() if None in months else F.lit(False))
            met = F.col(month).eqNullSafe(F.col("_m")) & (F.col("_block") == F.col("_b"))
            set_bit = F.call_function("getbit", F.col("mask"), F.pmod(F.col(ordinal), F.lit(BLOCK)).cast("int")) == 1
            out = out.where(here).join(found, met & set_bit).drop("_m", "_b", "mask")
        out = out.where(F.contains("_text", F.lit(needle)))
    out = out.drop("_text", "_block")
    if category and category != "all":
        out = out.where(F.col("category") == category)
    return out.join(read_ids, row, "left_anti") if read_ids is not None else out
