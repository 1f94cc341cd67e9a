"""Exact de-duplication with an extendible-hash index on shared files.

Texts count as equal when they are identical after all white space is deleted. The index keeps, per distinct text, its
hash key, digest, size and best row. Keys are dealt to buckets by their leading bits; while a bucket holds more than
``capacity`` distinct keys the directory doubles, so every bucket splits in two. The bucket is a column of the grouping by key
and text, which compares the bytes of different texts with one key; no task owns a bucket and no file is laid out by it.

Only DataFrame functions: copies are counted before the shuffle, so a text that a third of the rows share travels once
per map task, and the join that gives the group back to every row runs over narrow rows that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import SPACE, keep_decided, store, table, texts
from .queries import query

#: Distinct keys per bucket of the directory.
CAPACITY = 1 << 14
#: Leading bits a key has.
KEY_BITS = 64
_NO_ID = (1 << 63) - 1


def _big(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE + "+", "")


def bucket(key: Column, depth: int) -> Column:
    """Leading ``depth`` bits of a 64-bit key."""
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned(key, KEY_BITS - depth)


def directory_depth(entries: DataFrame, capacity: int = CAPACITY) -> int:
    """Double the directory until no bucket has over ``capacity`` distinct keys.

    Only one number per round reaches the driver. A key that many rows share counts once: a longer prefix can't split it.
    """
    keys = entries.select("key").distinct()
    n = keys.count()
    depth = max(0, n // max(1, capacity)).bit_length()
    while depth < KEY_BITS - 1:
        fullest = keys.groupBy(bucket(F.col("key"), depth).alias("bucket")).count().agg(F.max("count")).first()[0]
        if fullest is None or fullest <= capacity:
            break
        depth += 1
    return depth


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, key: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in its original text stays, then the one with the smallest id. A null
    text is empty, and empty texts are equal. A row without an id stays only if no other row of its group has one. Rows that
    repeat an id count one by one in group_size; all of them are marked as kept if their text is the longest of that id.
    An empty table gives no rows. ``key`` is the hash of the normalised text; a weak one only makes chains longer.
    """
    return _groups(docs, id_col, text_col, capacity, key).drop("points")


def _groups(docs: DataFrame, id_col: str, text_col: str, capacity: int = CAPACITY, key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """:func:`exact_groups` with the code points of each text."""
    base = texts(docs, id_col, text_col).select("doc_id", F.length("text").alias("points"), normalised(F.col("text")).alias("norm"))
    keyed = base.withColumn("key", key(F.col("norm")).cast("long"))
    entries = store(keyed.select("doc_id", "points", "key", F.sha2("norm", 256).alias("text_sha256")), "exact-entries")
    depth = directory_depth(entries, capacity)

    # Most points, then the smallest id, as one number: a decimal stays in the hash aggregate's fixed-size buffer.
    # Rows without an id come after all others.
    points = F.col("points") - F.when(F.col("doc_id").isNull(), F.lit(1 << 32)).otherwise(F.lit(0))
    rank = points.cast("decimal(11,0)") * _big(1 << 64) - F.coalesce("doc_id", F.lit(_NO_ID)).cast("decimal(20,0)")
    place = bucket(F.col("key"), depth).alias("bucket")
    chains = (  # bytes are compared here: the text itself is a grouping key
        keyed.select(place, "key", "norm", rank.cast("decimal(38,0)").alias("rank"))
        .groupBy("bucket", "key", "norm").agg(F.count("*").alias("group_size"), F.max("rank").alias("best"))
    )
    index = store(chains.select("bucket", "key", F.sha2("norm", 256).alias("text_sha256"), "group_size", "best"), "exact-index")
    rows = entries.withColumn("bucket", bucket(F.col("key"), depth)).withColumn("rank", rank.cast("decimal(38,0)"))
    joined = rows.join(index, ["bucket", "key", "text_sha256"])
    keep = F.pmod(-F.col("best"), _big(1 << 64))  # negative ids are the residues from 2**63 on
    keep = F.when(keep >= _big(1 << 63), keep - _big(1 << 64)).otherwise(keep).cast("long")
    return joined.select(
        "doc_id", F.when(keep != _NO_ID, keep).alias("keep_id"), "group_size", (F.col("rank") == F.col("best")).alias("kept"), "text_sha256", "points"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` drops, all columns unchanged.

    Rows that share an id, or have none, are decided one by one: those with different texts stay, of copies one is left.
    """
    decided = _groups(docs, id_col, text_col).select("doc_id", "kept", "text_sha256", "points")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    row = {"text_sha256": F.sha2(normalised(text), 256), "points": F.length(text)}
    out = keep_decided(docs, id_col, decided, "exact-gone", **row)
    if decided.where("kept").groupBy("doc_id", *row).count().where("count > 1").isEmpty():
        return out
    own = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = out.withColumns({"_exact_id": F.col(id_col).cast("long"), "_exact_sha256": F.sha2(normalised(own), 256), "_exact_points": F.length(own)})
    return named.dropDuplicates(["_exact_id", "_exact_sha256", "_exact_points"]).drop("_exact_id", "_exact_sha256", "_exact_points")


_SQL = """
WITH base AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS norm FROM documents
), ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM base
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM ranked
"""


@query("op4_exact_dedup", _SQL)
def op4_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))
