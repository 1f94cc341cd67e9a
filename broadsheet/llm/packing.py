"""Pattern packing: documents are cut into pieces of at most a sequence, and pieces are packed by their lengths alone.

The lengths of all pieces form a histogram of at most ``size`` rows. Patterns of a few lengths that fill a sequence are
enumerated, non-negative least squares fits how often each pattern repeats to the histogram, the counts are rounded down,
and what is left over is packed by best fit. A pattern that repeats a million times is one row of the plan, so the plan is
bounded by the enumeration, whatever the size of the corpus. Every piece has a rank among the pieces of its length; the
plan says which sequence and offset each range of ranks takes.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import slices, store, table, texts
from .queries import query

SIZE = 2048
#: Most patterns that are enumerated for one longest length.
PATTERNS_EACH = 40
FIT_ROUNDS = 300
#: Distinct words that a worker keeps with their ids.
CACHED_WORDS = 800_000
#: A single mark between an ASCII letter and white space: the vocabulary's pattern cuts there.
_MARK_AT_END = re.compile(rb"(?<=[A-Za-z])([.,])(?=[ \n]|$)")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- tokens


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True  # in a text, their strings are ordinary text
    return made, {}


def _stays_letters(word: str) -> bool:
    """The vocabulary's normalizer turns some letters into a letter and a mark, where its pattern cuts."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


def _encode_words(tokenizer, words: list[bytes]) -> list[bytes]:
    """Ids of words without white space. Words that are letters only once normalised are one piece before the merges: many
    go into one call, and those of a call that yields another number of pieces than words are encoded one by one."""
    out: dict[bytes, bytes] = {}
    plain, other = [], []
    for w in words:
        (plain if _stays_letters(w.decode()) else other).append(w)
    for at in range(0, len(plain), 64):
        some = plain[at : at + 64]
        got = tokenizer.encode(b" ".join(some).decode(), add_special_tokens=False)
        ids = np.array(got.ids, dtype="<u4")
        pieces_of = np.array(got.word_ids)
        if len(np.unique(pieces_of)) != len(some):
            other.extend(some)
            continue
        ends = np.searchsorted(pieces_of, np.arange(len(some) + 1)) * 4
        joined = ids.tobytes()
        for word, a, b in zip(some, ends.tolist(), ends[1:].tolist()):
            out[word] = joined[a:b]
    for at in range(0, len(other), 1024):
        some = other[at : at + 1024]
        for word, got in zip(some, tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)):
            out[word] = np.array(got.ids, dtype="<u4").tobytes()
    return [out[w] for w in words]


def token_buffers(raw: list[bytes], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers.

    The vocabulary is in lower case, drops white space and never joins across it, nor a letter with a mark after it; so the
    ids of a text are those of its words one after another. Words are encoded once per worker while the cache holds them.
    Only words of ASCII characters are put in lower case here: others are composed first, which lower case may forestall.
    """
    tokenizer, cache = _tokenizer(path)
    if len(cache) > CACHED_WORDS:
        cache.clear()
    split = [_MARK_AT_END.sub(rb" \1", r).split() for r in raw]
    split = [[w.lower() if w.isascii() else w for w in words] for words in split]
    new = list({w for words in split for w in words if w not in cache})
    cache.update(zip(new, _encode_words(tokenizer, new)))
    return [b"".join(map(cache.__getitem__, words)) for words in split]


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("place", pa.int64())])


def pieces(docs: DataFrame, size: int = SIZE, path: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and its place among the pieces of its length in its task.

    A document's ids end with one 0, so an empty or null text is one piece of length 1. Only documents longer than ``size``
    are cut.
    """

    def run(batches):
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for ids, raw in slices(batches):
            rows = []
            for key, buffer in zip(ids, token_buffers(raw, path)):
                buffer += b"\0\0\0\0"
                for k, at in enumerate(range(0, len(buffer), 4 * size)):
                    part = buffer[at : at + 4 * size]
                    n = len(part) // 4
                    place = seen.get(n, 0)
                    seen[n] = place + 1
                    rows.append((key, k, at // 4, n, zlib.crc32(part), task, place))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long")


# ---------------------------------------------------------------- plan


def patterns(counts: np.ndarray, size: int = SIZE, each: int = PATTERNS_EACH) -> np.ndarray:
    """Rows of up to four lengths (0: none), longest first, whose sum is ``size`` or as near below it as the lengths allow.

    Per longest length: the best partner, then partners spread over the lengths that leave a gap which one or two more
    lengths close.
    """
    have = np.flatnonzero(counts)
    have = have[have > 0]
    if not len(have):
        return np.empty((0, 4), dtype=np.int64)
    floor = np.zeros(size + 1, dtype=np.int64)  # longest length up to a gap
    floor[have] = have
    floor = np.maximum.accumulate(floor)
    found = [np.stack([have, *[np.zeros_like(have)] * 3], axis=1)]
    for a in have:
        gap = size - a
        second = have[(have <= min(a, gap))]
        if not len(second):
            continue
        if len(second) > each:
            second = np.unique(np.append(second[np.linspace(0, len(second) - 1, each).astype(int)], floor[min(a, gap)]))
        left = gap - second
        third = floor[np.minimum(left, second)]
        fourth = floor[np.minimum(left - third, np.maximum(third, 0))]
        found.append(np.stack([np.full_like(second, a), second, third, fourth], axis=1))
        half = floor[left // 2]  # two lengths of similar size close the gap
        rest = np.where(half > 0, floor[np.maximum(left - half, 0)], 0)
        found.append(np.stack([np.full_like(second, a), second, rest, half], axis=1))
    out = np.unique(-np.sort(-np.concatenate(found), axis=1), axis=0)
    total = out.sum(axis=1)
    return out[(total <= size) & (total > size - max(8, size // 64))]


def fit(found: np.ndarray, counts: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Non-negative least squares: how often each pattern repeats so that their lengths add up to ``counts``.

    Multiplicative updates, which stay non-negative; each round touches every pattern once.
    """
    target = counts.astype(float)
    target[0] = 0
    used = found > 0

    def spread(x):
        out = np.bincount(found.ravel(), weights=np.repeat(x, found.shape[1]), minlength=len(counts))
        out[0] = 0
        return out

    def gather(y):
        return (y[found] * used).sum(axis=1)

    x = np.full(len(found), max(target.sum() / max(1, 2 * len(found)), 1e-3))
    goal = gather(target)
    for _ in range(rounds):
        x *= goal / np.maximum(gather(spread(x)), 1e-12)
    return x


def plan(counts: np.ndarray, size: int = SIZE) -> list[tuple[int, list[int]]]:
    """(repeats, lengths) of every pattern used; together they use each length as often as ``counts`` says."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    out: list[tuple[int, list[int]]] = []

    def use(lengths: list[int], most: int | None = None) -> int:
        need = np.bincount(lengths, minlength=len(left))
        places = np.flatnonzero(need)
        times = int((left[places] // need[places]).min())
        if most is not None:
            times = min(times, most)
        if times > 0:
            left[places] -= times * need[places]
            out.append((times, lengths))
        return times

    if left[size]:
        use([size])
    found = patterns(left, size)
    if len(found):
        repeats = np.floor(fit(found, left) + 1e-9).astype(np.int64)
        exact = found.sum(axis=1)
        for k in np.lexsort((-repeats, -exact)):  # fullest patterns first
            if repeats[k] > 0:
                use([int(v) for v in found[k] if v], int(repeats[k]))
    while left.any():  # each turn uses up at least one length
        use(_best_fit(left, size))
    return out


def _best_fit(left: np.ndarray, size: int) -> list[int]:
    """The longest length that is left, then again and again the one or two lengths that fill the gap best."""
    have = np.flatnonzero(left)
    out = [int(have[-1])]
    spare = left.copy()
    spare[out[0]] -= 1
    gap = size - out[0]
    while gap > 0:
        fits = np.flatnonzero(spare[: gap + 1])
        if not len(fits):
            break
        floor = np.zeros(gap + 1, dtype=np.int64)
        floor[fits] = fits
        floor = np.maximum.accumulate(floor)
        partner = floor[gap - fits]
        partner = np.where((partner == fits) & (spare[fits] < 2), 0, partner)
        total = fits + partner
        best = np.flatnonzero(total == total.max())[-1]  # the longest of those that fill best
        for v in (int(fits[best]), int(partner[best])):
            if v:
                out.append(v)
                spare[v] -= 1
                gap -= v
    return out


def slots(made: list[tuple[int, list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of ranks per length as (key, first sequence, offset), sorted by key = length << 44 | first rank."""
    next_rank: dict[int, int] = {}
    rows = []
    sequence = 0
    for times, lengths in made:
        offset = 0
        for n in lengths:
            first = next_rank.get(n, 0)
            next_rank[n] = first + times
            rows.append((n << 44 | first, sequence, offset))
            offset += n
        sequence += times
    rows.sort()
    return tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) if rows else (np.empty(0, np.int64),) * 3


def pack(docs: DataFrame, size: int = SIZE, path: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece that holds only the closing 0; rows that repeat an id are packed one by one; an empty
    table gives no rows. The plan's broadcast is bounded by the enumeration (``PATTERNS_EACH`` per length).
    """
    spark = docs.sparkSession
    cut = store(pieces(docs, size, path, id_col, text_col), "packing-pieces")
    per_task = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(size + 1, dtype=np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length
        counts[row["length"]] = row["n"]
    ranges = spark.sparkContext.broadcast(slots(plan(counts, size)))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank"))

    def seat(batches):
        keys, sequences, places = ranges.value
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (3, 5))
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            sequence = sequences[at] + rank - (keys[at] & ((1 << 44) - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(places[at])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(seat, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
