"""Substring de-duplication by recompression.

Recompression parses all texts in rounds: first maximal runs of one word get one name, then, round after round, pairs of
neighbours whose symbols fall on the left and the right side of a random split of the alphabet. A name is a fingerprint of
what it stands for, so every task gives equal things equal names and no dictionary travels. Equal substrings therefore
carry the same symbols inside; only a symbol at either end of each round depends on what stands around them.

For each window of words the symbols that do not depend on the surroundings are followed upwards. The smallest name among
the last of them, with the words on the side where the window reaches further, is the window's anchor: about half of its
words, found alike in equal windows. Neighbouring windows share anchors, so there is one row per anchor occurrence (a
segment of windows), and only anchors that occur more than once go on. Of those, segments whose whole stretch of words is
equal settle together; where one anchor stands in different stretches, one representative of each distinct stretch is cut
into windows, and these are compared one by one.

Symbols only choose candidates; stretches and windows are told apart by 128-bit fingerprints of their words. Rows of one
anchor meet in one task unless the anchor is very frequent; a sketch of all anchors knows those beforehand, and their rows
are spread, since they need no partner to be candidates.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import combine, discard, doc_words, long, mix, slices, store, table, text_bytes, texts
from .queries import query

WINDOW = 13
#: Pair rounds. Each makes symbols longer and takes half a symbol from either end of a window.
ROUNDS = 1
#: Buckets of the sketch of anchors, and how many rows above twice the mean make a bucket's anchors frequent ones.
SKETCH_BITS = 16
FREQUENT = 10_000
#: Bits of a place that hold the number of windows; the first window is above them.
PLACE_BITS = 12
#: Tasks that the rows of a frequent anchor are spread over.
SPREAD = 64
_U = np.uint64
_BASE = 0xC2B2AE3D27D4EB4F


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(max(n, 1), b, dtype=_U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _stretch(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprint of the words from ``starts`` up to ``ends``."""
    up, down = _powers(len(words) + 1)
    run = np.empty(len(words) + 1, dtype=_U)
    run[0] = 0
    np.cumsum(words * up[: len(words)], out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(_U))


def recompress(symbols: np.ndarray, doc: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One round over symbols and the documents they are in: new symbols, first old symbol of each, new place of each old
    symbol, and the side of each old symbol (round 0: no sides, runs of equal symbols get a name)."""
    if level == 0:
        begins = np.ones(len(symbols), dtype=bool)
        begins[1:] = (symbols[1:] != symbols[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(begins)
        size = np.diff(np.append(first, len(symbols)))
        names = symbols[first]
        names = np.where(size > 1, combine([names, size.astype(_U)]), names)
        return names, first, np.cumsum(begins) - 1, np.zeros(len(symbols), dtype=bool)
    right = (mix(symbols + _U(level * 0x9E3779B9)) & _U(1)).astype(bool)
    joins = np.zeros(len(symbols), dtype=bool)  # this symbol is the right half of a pair
    joins[1:] = right[1:] & ~right[:-1] & (doc[1:] == doc[:-1])
    first = np.flatnonzero(~joins)
    names = symbols[first].copy()
    paired = np.append(joins[1:], False)[first]
    at = first[paired]
    names[paired] = combine([symbols[at], symbols[at + 1], np.full(len(at), level, dtype=_U)])
    return names, first, np.cumsum(~joins) - 1, right


def anchors(words: np.ndarray, offsets: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window inside a document: its first word, and first and last word (exclusive) of its anchor."""
    sizes = np.diff(offsets)
    n_windows = np.maximum(sizes - window + 1, 0)
    ends = np.cumsum(n_windows)
    start = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[:-1] - (ends - n_windows), n_windows)
    left, right = np.zeros(len(start), dtype=np.int64), np.zeros(len(start), dtype=np.int64)
    symbols, doc = words, np.repeat(np.arange(len(sizes)), sizes)
    word = np.arange(len(words) + 1)  # first word of each symbol, and the end
    open_, low, high = np.arange(len(start)), start.copy(), start + window
    level = 0
    while len(open_):
        names, first, moved, side = recompress(symbols, doc, level)
        last = high - 1
        if level == 0:  # a run at either end may go on outside
            new_low, new_high = moved[low] + 1, moved[last]
        else:  # a right half at the front, or a left half at the back, may have its partner outside
            new_low, new_high = moved[low] + side[low], moved[last] + side[last]
        done = (new_low >= new_high) | (level > rounds)
        if done.any():
            at, a, b = open_[done], low[done], high[done]
            scores = mix(symbols)
            best, score = a.copy(), scores[a]
            for k in range(1, int((b - a).max())):
                here = np.minimum(a + k, len(symbols) - 1)
                better = (a + k < b) & (scores[here] < score)
                best, score = np.where(better, here, best), np.where(better, scores[here], score)
            left[at], right[at] = word[best], word[best + 1]
        more = ~done
        open_, low, high = open_[more], new_low[more], new_high[more]
        symbols, doc, word = names, doc[first], np.append(word[first], len(words))
        level += 1
    reach = -(-(window - (right - left)) // 2)  # the window has so many words on one side at least
    behind = left - start >= start + window - right
    return start, left - np.where(behind, reach, 0), right + np.where(behind, 0, reach)


def segments(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per run of neighbouring windows with one anchor occurrence: the anchor's fingerprint, and the first window and
    the number of windows as one number (:func:`_place`), which keeps the rows that are shuffled small."""

    def run(batches):
        for ids, raw in slices(batches):
            offsets, (words,) = doc_words(raw)
            owner, first, n, anchor = _segments(words, offsets, window)
            keys = pa.array(ids, pa.int64()).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([long(anchor), keys, pa.array(_place(first, n))], names=["anchor", "doc_id", "place"])

    return docs.mapInArrow(run, "anchor long, doc_id long, place long")


def _place(first, n):
    return (first.astype(np.int64) << PLACE_BITS) + n


def _segments(words: np.ndarray, offsets: np.ndarray, window: int):
    start, left, right = anchors(words, offsets, window)
    owner = np.searchsorted(offsets, start, side="right") - 1
    new = np.ones(len(start), dtype=bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(start)))
    return owner[at], (start[at] - offsets[owner[at]]).astype(np.int32), n.astype(np.int32), _stretch(words, left[at], right[at])


def _frequent(docs: DataFrame, window: int) -> np.ndarray:
    """Which hash buckets of anchors may hold a very frequent one, from counts over all documents."""

    def run(batches):
        seen = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for _, raw in slices(batches):
            offsets, (words,) = doc_words(raw)
            anchor = _segments(words, offsets, window)[3]
            seen += np.bincount((anchor >> _U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["bucket", "n"])

    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for row in docs.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out > 2 * out.mean() + FREQUENT


def _with_lists(batches, size: int = 1 << 20):
    """(doc_id, text, list of structs) batches in slices of about ``size`` bytes: ids, texts, the length of each text's list
    and the lists' fields end to end."""
    for batch in batches:
        raw = list(text_bytes(batch.column(1)))
        counts = pc.fill_null(pc.list_value_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = batch.column(2).flatten()
        fields = {f.name: flat.field(k).to_numpy(zero_copy_only=False) for k, f in enumerate(flat.type)}
        ends = np.cumsum(counts)
        at = 0
        while at < len(raw):
            to, total = at, 0
            while to < len(raw) and (to == at or total + len(raw[to]) <= size):
                total += len(raw[to])
                to += 1
            a, b = ends[at] - counts[at], ends[to - 1]
            yield batch.column(0).slice(at, to - at), raw[at:to], counts[at:to], {n: v[a:b] for n, v in fields.items()}
            at = to


def _placed(offsets: np.ndarray, counts: np.ndarray, fields: dict, window: int):
    """For segments of a slice's texts: which text, first and last word, and whether the text has them all (rows that repeat
    an id may differ in length)."""
    of = np.repeat(np.arange(len(counts)), counts)
    first, n = fields["first"].astype(np.int64), fields["n"].astype(np.int64)
    start = offsets[of] + first
    return of, start, start + n + window - 1, start + n + window - 1 <= offsets[of + 1]


def _stretches(held: DataFrame, window: int) -> DataFrame:
    """The wanted segments of each text with the fingerprint of all their words."""

    def run(batches):
        for ids, raw, counts, fields in _with_lists(batches):
            fields |= {"first": fields["place"] >> PLACE_BITS, "n": fields["place"] & ((1 << PLACE_BITS) - 1)}
            offsets, (words,) = doc_words(raw, seeds=(1,))
            of, start, end, inside = _placed(offsets, counts, fields, window)
            of, start, end = of[inside], start[inside], end[inside]
            columns = [pa.array(fields["anchor"][inside]), long(_stretch(words, start, end)), ids.take(pa.array(of)), pa.array(fields["first"][inside].astype(np.int32)), pa.array(fields["n"][inside].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "stretch", "doc_id", "first", "n"])

    return held.mapInArrow(run, "anchor long, stretch long, doc_id long, first int, n int")


def _windows(asked: DataFrame, window: int) -> DataFrame:
    """Windows of the asked segments of each text, each with a 128-bit fingerprint."""

    def run(batches):
        for ids, raw, counts, fields in _with_lists(batches):
            offsets, (a, b) = doc_words(raw, seeds=(0, 1))
            of, start, _, inside = _placed(offsets, counts, fields, window)
            n = np.where(inside, fields["n"], 0).astype(np.int64)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(start, n) + k
            columns = [ids.take(pa.array(np.repeat(of, n))), *[pa.array(np.repeat(fields[c], n)) for c in ("anchor", "stretch")], pa.array(k.astype(np.int32))]
            columns += [long(_stretch(words, at, at + window)) for words in (a, b)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "anchor", "stretch", "k", "a", "b"])

    return asked.mapInArrow(run, "doc_id long, anchor long, stretch long, k int, a long, b long")


def _held(docs: DataFrame, window: int) -> DataFrame:
    """Documents with segments whose anchor occurs again somewhere: doc_id, text, and the segments."""
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, window))
    # What differs from row to row stands together, and the id, which often doesn't, behind it: shuffled rows compress better.
    rows = segments(docs, window).select("anchor", "place", "doc_id")
    bits = F.shiftrightunsigned("anchor", 64 - SKETCH_BITS)
    buckets = [int(b) for b in np.flatnonzero(frequent.value)]
    spread = bits.isin(buckets) if buckets else F.lit(False)
    rows = rows.withColumn("spread", F.when(spread, 1 + F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD))).otherwise(0).cast("byte"))
    together = Window.partitionBy("anchor", "spread")
    met = rows.withColumn("times", F.count("*").over(together)).where("spread > 0 OR times > 1")
    lists = store(met.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "place")).alias("wanted")), "repeats-lists")
    held = store(docs.join(lists, "doc_id").select("doc_id", "text", "wanted"), "repeats-held")
    discard(lists)
    return held


def _spans(held: DataFrame, window: int) -> DataFrame:
    """(doc_id, spans): the windows of held documents, as (first, n), that also start in a document with a smaller id."""
    met = store(_stretches(held, window), "repeats-met")
    # The smallest document of a stretch, with a place in it, as one number: it stays in the hash aggregate's buffer.
    wide = F.lit(str(1 << 44)).cast("decimal(20,0)")
    place = F.shiftleft(F.col("first").cast("long"), PLACE_BITS) + F.col("n")
    packed = (F.col("doc_id").cast("decimal(20,0)") * wide + place.cast("decimal(18,0)")).cast("decimal(38,0)")
    packs = met.groupBy("anchor", "stretch").agg(F.min(packed).alias("least"), F.max("doc_id").alias("high")).withColumn("place", F.pmod("least", wide))
    low = ((F.col("least") - F.col("place")) / wide).cast("long")
    stretches = store(packs.select("anchor", "stretch", low.alias("low"), "high", F.col("place").cast("long").alias("place")), "repeats-stretches")
    several = stretches.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    mixed = store(stretches.join(several, "anchor", "left_semi").select("anchor", "stretch", "low", "place"), "repeats-mixed")

    # Windows of one representative per distinct stretch, in the document with the smallest id that has it.
    first, n = F.shiftright("place", PLACE_BITS).cast("int"), F.col("place").bitwiseAND((1 << PLACE_BITS) - 1).cast("int")
    chosen = mixed.select(F.col("low").alias("doc_id"), "anchor", "stretch", first.alias("first"), n.alias("n"))
    asked = chosen.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "stretch", "first", "n")).alias("wanted"))
    cut = store(_windows(held.select("doc_id", "text").join(asked, "doc_id").select("doc_id", "text", "wanted"), window), "repeats-windows")
    # A window that only one document has among the representatives has no smaller one anywhere.
    least = cut.groupBy("a", "b").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n")).where("n > 1").select("a", "b", "least")
    alone = mixed.select("anchor", "stretch", F.lit(None).cast("int").alias("k"), F.col("low").alias("least"))
    verdicts = cut.join(least, ["a", "b"]).select("anchor", "stretch", "k", "least").union(alone).groupBy("anchor", "stretch").agg(
        F.min(F.when(F.col("k").isNull(), F.col("least"))).alias("low"), F.collect_list(F.struct("k", "least")).alias("windows")
    )
    settled = stretches.join(several, "anchor", "left_anti").where("low < high").select("anchor", "stretch", "low", F.array().cast(verdicts.schema["windows"].dataType).alias("windows"))
    # Written before the segments meet it, so that the join reads plain shuffles, which can be split.
    verdicts = store(settled.union(verdicts), "repeats-verdicts")
    discard(stretches, mixed, cut)

    # Of a stretch that an earlier document has, all windows go; of others, those that stand in another stretch earlier.
    some = F.transform(F.filter("windows", lambda w: w["k"].isNotNull() & (w["least"] < F.col("doc_id"))), lambda w: F.struct((F.col("first") + w["k"]).alias("first"), F.lit(1).alias("n")))
    found = met.join(verdicts, ["anchor", "stretch"]).select("doc_id", F.when(F.col("low") < F.col("doc_id"), F.array(F.struct("first", "n"))).otherwise(some).alias("spans"))
    spans = store(found.where(F.size("spans") > 0).groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans")), "repeats-spans")
    discard(met, verdicts)
    return spans


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, spans) of the documents of :func:`texts` that have windows which also start in a document with a smaller id."""
    held = _held(docs.where("doc_id IS NOT NULL"), window)
    spans = _spans(held, window)
    discard(held)
    return spans


def _gone(offsets: np.ndarray, counts: np.ndarray, fields: dict, window: int) -> np.ndarray:
    """Which words of a slice's texts the windows of their spans cover."""
    _, start, end, inside = _placed(offsets, counts, fields, window)
    steps = np.bincount(start[inside], minlength=offsets[-1] + 1) - np.bincount(end[inside], minlength=offsets[-1] + 1)
    return np.cumsum(steps)[:-1] > 0


def _kept(raw: list[bytes], counts: np.ndarray, fields: dict, window: int):
    """Per text its words and those that stay."""
    words = [r.split() for r in raw]
    offsets = np.cumsum([0, *map(len, words)])
    stay = (~_gone(offsets, counts, fields, window)).tolist()
    for own, at in zip(words, offsets.tolist()):
        yield own, list(compress(own, stay[at : at + len(own)]))


def removed(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed and kept_sha256 (of the words that stay, joined by a space).

    A word goes when a window of ``window`` words that covers it also starts in a document with a smaller id. Windows are
    those of the input. Null, empty and short texts have no windows. A row without an id loses nothing and makes nobody
    else lose; rows that repeat an id count as one document. An empty table gives no rows.
    """
    base = texts(docs, id_col, text_col)
    held = _held(base.where("doc_id IS NOT NULL"), window)
    spans = _spans(held, window)

    def sha(words: list[bytes]) -> str:
        return hashlib.sha256(b" ".join(words)).hexdigest()

    def whole(batches):
        for batch in batches:
            words = [raw.split() for raw in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, words)), pa.int64()), pa.array(list(map(sha, words)), pa.string())], names=["doc_id", "n_words", "sha256"])

    def cut(batches):
        for ids, raw, counts, fields in _with_lists(batches):
            rows = [(len(own) - len(stay), sha(stay), sha(own)) for own, stay in _kept(raw, counts, fields, window)]
            columns = zip(*rows)
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string()))]], names=["doc_id", "n_removed", "kept_sha256", "sha256"])

    every = base.mapInArrow(whole, "doc_id long, n_words long, sha256 string")
    edited = held.select("doc_id", "text").join(spans, "doc_id").mapInArrow(cut, "doc_id long, n_removed long, kept_sha256 string, sha256 string")
    edited = store(edited.dropDuplicates(["doc_id", "sha256"]), "repeats-edited")
    discard(held, spans)
    joined = every.join(edited, ["doc_id", "sha256"], "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))


def cut_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each text that loses words replaced by the words that stay, joined by a space; see :func:`removed`.

    A text that loses nothing, null included, is unchanged, and so are the other columns, but for ``n_chars``, which follows
    the new text where there is such a column. No row goes, also when all its words do.
    """
    found = repeats(texts(docs, id_col, text_col), window).select(F.col("doc_id").alias("_repeats_id"), F.col("spans").alias("_repeats_spans"))
    joined = docs.join(found, docs[id_col].cast("long") == found["_repeats_id"], "left").drop(found["_repeats_id"])
    place, schema = docs.columns.index(text_col), docs.schema

    def run(batches):
        for batch in batches:
            last = batch.num_columns - 1
            old = batch.column(place)
            lists = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), old, batch.column(last)], names=["row", "text", "spans"])
            new = old.to_pylist()
            for rows, raw, counts, fields in _with_lists([lists]):
                for row, has, (_, stay) in zip(rows.to_pylist(), counts.tolist(), _kept(raw, counts, fields, window)):
                    if has:
                        new[row] = b" ".join(stay).decode()
            columns = list(batch.columns[:-1])
            columns[place] = pa.array(new, old.type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    cut = joined.mapInArrow(run, schema)
    if "n_chars" in docs.columns and text_col != "n_chars":
        cut = cut.withColumn("n_chars", F.length(text_col).cast(schema["n_chars"].dataType))
    return cut


_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
), wins AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)
), firsts AS (SELECT g, min(doc_id) AS low FROM wins GROUP BY g
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM wins JOIN firsts USING (g) WHERE low < doc_id
), words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), per AS (
  SELECT words.doc_id, count(gone.p) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL), '') AS kept
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p GROUP BY words.doc_id
)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN per USING (doc_id)
"""


@query("op3_substring_dedup", _SQL)
def op3_substring_dedup(spark, sf_dir):
    return removed(table(spark, sf_dir, "documents"))
