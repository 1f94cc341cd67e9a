"""What the operators of this folder share: reading, storing, Arrow text batches and word fingerprints."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.session import shared_folder

#: White space between words, as a Java character class and as characters.
SPACE = "[\\x20\\x09-\\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later jobs neither repeat its work nor lose it."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    release_shuffles(df.sparkSession)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def release_shuffles(spark: SparkSession) -> None:
    """Shuffle files of finished jobs go when the driver collects the objects that own them. Long jobs of many steps would
    otherwise hold the files of all steps until the driver happens to need memory."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*stored: DataFrame) -> None:
    """Delete tables that :func:`store` wrote and that nothing still to run reads."""
    for df in stored:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(conf).delete(path, True)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, under fixed names; a null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``, also below lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def keep_decided(docs: DataFrame, id_col: str, decided: DataFrame, purpose: str, **also: Column) -> DataFrame:
    """``docs`` without the ids of which no row of ``decided`` (doc_id, kept) is kept; all columns unchanged.

    The ids that go are fewer than those that stay, so they are the side that meets the texts. Rows that share an id, or have
    none, are told apart by ``also``: columns of ``decided`` and what equals them in ``docs``. Rows alike in all of it share
    one decision.
    """
    any_kept = decided.groupBy("doc_id", *also).agg(F.max(F.col("kept").cast("int")).alias("any"))
    gone = store(any_kept.where("any = 0").select(F.col("doc_id").alias("_gone"), *[F.col(k).alias(f"_gone_{k}") for k in also]), purpose)
    same = docs[id_col].cast("long").eqNullSafe(gone["_gone"])
    for k, value in also.items():
        same &= value == gone[f"_gone_{k}"]
    return docs.join(gone, same, "left_anti")


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow column."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def slices(batches, size: int = 1 << 20) -> Iterator[tuple[list[int], list[bytes]]]:
    """Ids and UTF-8 texts of (doc_id, text) batches in slices of about ``size`` bytes; a longer text is a slice of its own."""
    ids: list = []
    raw: list[bytes] = []
    total = 0
    for batch in batches:
        for key, value in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            if raw and total + len(value) > size:
                yield ids, raw
                ids, raw, total = [], [], 0
            ids.append(key)
            raw.append(value)
            total += len(value)
    if raw:
        yield ids, raw


_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, kept between calls up to a few MB."""
    have = _powers.get(seed)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        base = _BASES[seed]
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=_U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = (out[0], out[1])
        if size <= 1 << 21:
            _powers[seed] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x = x ^ (x >> _U(27))
    x = x * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


_BYTE = [mix(np.arange(1, 257, dtype=_U) * _U(2 * s + 3) + _U(0x1234567 + s)) | _U(1) for s in (0, 1)]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES.encode())] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in UTF-8 bytes."""
    edge = np.empty(len(data) + 2, dtype=np.int8)
    edge[0] = edge[-1] = 1
    edge[1:-1] = _IS_SPACE[data]
    turn = np.diff(edge)
    return np.flatnonzero(turn == -1), np.flatnonzero(turn == 1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit fingerprint of each word: a polynomial over its bytes, scrambled."""
    if not len(starts):
        return np.empty(0, dtype=_U)
    up, down = _power(seed, len(data))
    run = np.empty(len(data) + 1, dtype=_U)
    run[0] = 0
    np.cumsum(_BYTE[seed][data] * up, out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts])


def doc_words(raw: list[bytes], seeds: tuple[int, ...] = (0,), lower: bool = False):
    """Words of several texts at once: offsets of each text's words, and the words' fingerprints per seed."""
    data = np.frombuffer(b"\n".join(raw), dtype=np.uint8)
    if lower:
        data = _LOWER[data]
    starts, ends = words_of(data)
    limits = np.cumsum([len(r) + 1 for r in raw])
    offsets = np.concatenate([[0], np.searchsorted(starts, limits)])
    return offsets, [word_hashes(data, starts, ends, s) for s in seeds]


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """Fingerprint of a fixed-length sequence, given the fingerprints of its places."""
    out = np.zeros(len(parts[0]), dtype=_U)
    for p in parts:
        out = mix(out * _U(0xD1342543DE82EF95) + p + _U(0x632BE59BD9B4E019))
    return out


def long(x: np.ndarray) -> pa.Array:
    """Unsigned fingerprints as signed longs."""
    return pa.array(x.view(np.int64))
