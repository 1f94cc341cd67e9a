"""Compression of vectors to product codes with exact integer arithmetic.

Components become integers. Distances to codebook entries need dot products of integers, which BLAS has for floats only: the
integers are broken into limbs so narrow that every float64 product sum stays below 2**53 and so is exact; the limbs' products
are shifted and added in int64. The nearest entry is the first smallest distance.

Each round is one pass over the vectors: a task adds up the parts of every entry, Spark adds up the tasks' sums, and only the
codebooks (at most parts x entries x part width integers) pass through the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import store, table
from .queries import query

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256


# ---------------------------------------------------------------- exact products


def limb_bits(width: int) -> int:
    """Bits of a limb, so that sums of ``width`` products of limbs stay below 2**53."""
    return (52 - max(width - 1, 0).bit_length()) // 2


def _limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """``x`` as float64 limbs, lowest first: x = sum of limb[k] * 2**(bits * k). Only the highest one has a sign."""
    out = []
    while x.size and (x.max() >= 1 << bits or x.min() < -(1 << bits)):
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of the rows of int64 ``a`` (.., n, k) and ``b`` (.., m, k) as int64 (.., n, m), exact if they fit in it."""
    bits = limb_bits(a.shape[-1])
    total = np.zeros((*a.shape[:-1], b.shape[-2]), dtype=np.int64)
    right = [np.swapaxes(x, -1, -2) for x in _limbs(b, bits)]
    for i, x in enumerate(_limbs(a, bits)):
        for j, y in enumerate(right):
            if bits * (i + j) < 64:
                total += np.matmul(x, y).astype(np.int64) << np.int64(bits * (i + j))
    return total


def nearest(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For int64 vectors (n, parts * k) and books (parts, entries, k): the first nearest entry of each part and its squared
    distance, both (parts, n)."""
    parts, _, k = books.shape
    cut = vectors.reshape(len(vectors), parts, k).transpose(1, 0, 2)
    away = (books * books).sum(axis=2)[:, None, :] - 2 * exact_products(cut, books)
    code = away.argmin(axis=2)
    return code, np.take_along_axis(away, code[:, :, None], axis=2)[:, :, 0] + (cut * cut).sum(axis=2)


# ---------------------------------------------------------------- rounds


def _integers(column: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of a list column without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * scale)
    if whole.size and np.abs(whole).max() >= 2.0**30 / max(1, len(flat) // max(1, len(column))) ** 0.5:
        raise ValueError("squared distances of these components do not fit in 64 bits")
    return whole.astype(np.int64).reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vec_col: str, *also: str) -> DataFrame:
    """The id, the vector and ``also`` of rows whose vector is not null and holds finite components only."""
    odd = F.exists(F.col(vec_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vec_col).isNotNull() & ~F.coalesce(odd, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"), *[F.col(c) for c in also])


def _sums(kept: DataFrame, books: np.ndarray, scale: int) -> np.ndarray:
    """The books after one round: floor of the mean of each entry's parts, entries without parts unchanged."""
    parts, entries, k = books.shape

    def run(batches):
        total = np.zeros((parts, entries, k), dtype=np.int64)
        count = np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            whole = _integers(batch.column(0), scale)
            code, _ = nearest(whole, books)
            cut = whole.reshape(len(whole), parts, k)
            for p in range(parts):
                np.add.at(total[p], code[p], cut[:, p])
                count[p] += np.bincount(code[p], minlength=entries)
        used = np.argwhere(count)
        yield pa.RecordBatch.from_pydict({"part": pa.array(used[:, 0], pa.int32()), "entry": pa.array(used[:, 1], pa.int32()), "n": pa.array(count[count > 0]), "total": pa.array(list(total[count > 0]), pa.list_(pa.int64()))})

    made = kept.select("vec").mapInArrow(run, "part int, entry int, n long, total array<long>")
    places = [F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(k)]
    out = books.copy()
    for row in made.groupBy("part", "entry").agg(F.sum("n").alias("n"), *places).collect():
        out[row["part"], row["entry"]] = [row[f"t{i}"] // row["n"] for i in range(k)]
    return out


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray | None:
    """Codebooks (parts, entries, width) of (vec_id, vec) rows; None without rows. Only the first books, the parts of the
    ``entries`` smallest ids, are a bounded choice; every round reads all vectors."""
    first = kept.where("vec_id IS NOT NULL").orderBy("vec_id", "vec").select("vec").limit(entries).collect() or kept.orderBy("vec").select("vec").limit(entries).collect()
    if not first:
        return None
    width = len(first[0]["vec"])
    if not width or width % parts:
        raise ValueError(f"vectors of {width} components can't be cut into {parts} equal parts")
    start = _integers(pa.array([r["vec"] for r in first if len(r["vec"]) == width], pa.list_(pa.float64())), scale)
    books = np.ascontiguousarray(start.reshape(len(start), parts, width // parts).transpose(1, 0, 2))
    alike = kept.where(F.size("vec") == width)
    for _ in range(rounds):
        books = _sums(alike, books, scale)
    return books


def books_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.reshape(-1).tolist()))


def encode(kept: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code (two hex digits per part) and error (squared distances, summed over parts) of each row."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            code, away = nearest(_integers(batch.column(1), scale), books)
            text = [bytes(c).hex() for c in np.ascontiguousarray(code.T).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(text, pa.string()), pa.array(away.sum(axis=0))], names=["vec_id", "label", "code", "error"])

    width = books.shape[0] * books.shape[2]
    label = kept.schema["label"].dataType.simpleString()
    return kept.where(F.size("vec") == width).select("vec_id", "vec", "label").mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per usable row of ``vectors``: vec_id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds null or non-finite components go, as do vectors of another length than the one with
    the smallest id, which have no parts to compare. Rows without an id are coded but give no first codebook entry (unless no
    row has an id); rows that share an id or repeat are coded one by one, the smaller vector first in the first codebook.
    Null labels are one label. Fewer rows than ``entries`` make smaller books, an empty table gives no rows. A length that
    ``parts`` does not divide, and components whose distances do not fit in 64 bits, are errors. Other columns are not read.
    """
    if entries > 256:
        raise ValueError("two hex digits hold at most 256 entries")
    kept = usable(vectors, id_col, vec_col, label_col).withColumnRenamed(label_col, "label")
    books = train(kept, parts, entries, rounds, scale)
    shape = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if books is None:
        return vectors.sparkSession.createDataFrame([], shape)
    coded = store(encode(kept, books, scale), "codes")
    per_label = store(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "code-labels")
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    joined = coded.join(per_label, coded["label"].eqNullSafe(per_label["_label"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


# ---------------------------------------------------------------- query

_ROUND = """
far{r} AS (SELECT p.row, p.part, b.entry, sum((p.v - b.v) * (p.v - b.v)) AS d FROM places p JOIN books{r} b ON p.part = b.part AND p.pos = b.pos GROUP BY 1, 2, 3),
near{r} AS (SELECT row, part, min(d) AS d, arg_min(entry, d * 64 + entry) AS entry FROM far{r} GROUP BY 1, 2),"""
_BOOKS = """
means{r} AS (SELECT n.part, n.entry, p.pos, CAST(floor(sum(p.v)::DOUBLE / count(*)) AS BIGINT) AS v FROM near{r} n JOIN places p ON n.row = p.row AND n.part = p.part GROUP BY 1, 2, 3),
books{s} AS (SELECT b.part, b.entry, b.pos, coalesce(m.v, b.v) AS v FROM books{r} b LEFT JOIN means{r} m ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos),"""

SQL = (
    """WITH kept AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS row, len(embedding) // 16 AS k FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
cells AS (SELECT row, k, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM kept),
places AS (SELECT row, i // k AS part, i % k AS pos, CAST(floor(256 * x::DOUBLE) AS BIGINT) AS v FROM cells),
books0 AS (SELECT part, row AS entry, pos, v FROM places WHERE row < 64),"""
    + "".join(_ROUND.format(r=r) + _BOOKS.format(r=r, s=r + 1) for r in range(ROUNDS))
    + _ROUND.format(r=ROUNDS)
    + f"""
coded AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY row),
digest AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM books{ROUNDS})
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, g.codebooks_sha256
FROM coded c JOIN kept k ON c.row = k.row CROSS JOIN digest g"""
)


@query("op11_vector_codes", SQL)
def op11_vector_codes(spark, sf_dir):
    return compress(table(spark, sf_dir, "embeddings"))
