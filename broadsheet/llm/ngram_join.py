"""Self-join of documents on the Jaccard similarity of their word n-grams, and the groups that the links form.

Most documents have no partner, and their n-grams say so: a set that has more n-grams of its own than a link may miss can't
link. One hash class of the n-grams is counted over all documents, which settles most sets; of the others all n-grams are
counted, which settles most of the rest.

Of what is left, equal sets are one set from the start. n-grams are ordered rare first: those that only one set holds (they meet
nothing, but count as places), then the others, the most frequent ones by their exact counts at the end. Two sets that are
similar enough share an n-gram among the first few of either (the prefix), so rows meet on prefix n-grams only. Where they meet,
the length filter, the positional filter and a bound on the Hamming distance of the remaining sets (the suffix filter, from a
bitmap of element parities) decide inside the join whether the pair goes on. Each remaining pair is verified once, on the whole
sets.

A group of near copies must not be written out as all its pairs. So the join runs in two rounds: first every row meets one
hub per prefix n-gram, the row with the fewest n-grams of its own; then rows meet only rows of another component, and a
component that holds most of an n-gram's rows is met by the others, not by itself. A link between different sets is either
found or lies inside one component, so the components are those of all links.

Rows are told apart by a fingerprint of id and set, so different texts under one id stay different documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import combine, discard, doc_words, long, mix, slices, store, table, text_bytes, texts
from .components import components
from .queries import query

N = 4
#: Similarity in percent.
LEAST = 85
#: The most frequent n-grams, as many at most, come last in the order, by their counts; they are what tasks are sent. Only
#: n-grams of so many sets are looked at for it.
MOST_HOT, HELD_OFTEN = 1 << 16, 8
WORDS_OF_BITS = 8
#: Bits of the filters that let the texts of undecided rows pass.
BLOOM_BITS = 27
#: One in so many hash classes of n-grams is counted to settle sets without partners.
CLASSES = 4
_U = np.uint64


# ---------------------------------------------------------------- sets


def ngram_sets(raw: list[bytes], n: int = N, unique: bool = True):
    """Sorted distinct n-gram fingerprints of each text, ASCII letters in lower case; a shorter text is one n-gram."""
    offsets, (words,) = doc_words(raw, lower=True)
    grams = combine([words[i : len(words) - n + 1 + i] for i in range(n)]) if len(words) >= n else words[:0]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= n:
            own = grams[a : b - n + 1]
            yield np.unique(own) if unique else own
        elif b > a:
            one = np.array([b - a], dtype=_U)
            for k in range(a, b):
                one = combine([one, words[k : k + 1]])
            yield one
        else:
            yield words[:0]


def prefix_length(size: int, least: int = LEAST) -> int:
    return size - -(-least * size // 100) + 1


def _prints(own: np.ndarray) -> tuple[int, int]:
    return np.sum(mix(own), dtype=_U), np.sum(mix(own ^ _U(0xA5A5F00D12345677)), dtype=_U)


def _row_ids(keys: list, sets: list[np.ndarray]) -> tuple[np.ndarray, list[tuple]]:
    """64-bit fingerprints of rows, from their ids and sets, and (size, print_a, print_b) of the sets."""
    prints = [(len(own), *_prints(own)) for own in sets]
    size, a, b = (np.array(c, dtype=_U) for c in zip(*prints))
    return combine([size, a, b, np.array([k or 0 for k in keys], dtype=np.int64).view(_U)]), prints


def fingerprints(docs: DataFrame, n: int = N) -> DataFrame:
    """Per row of (doc_id, text, digest): the row's fingerprint, the size of its set and the set's 128-bit fingerprint."""

    def run(batches):
        for batch in batches:
            numbered = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column(1)], names=["place", "text"])
            for places, raw in slices([numbered]):
                some = batch.slice(places[0], len(places))
                rows, prints = _row_ids(some.column(0).to_pylist(), list(ngram_sets(raw, n)))
                size, a, b = zip(*prints)
                columns = [some.column(0), some.column(2), long(rows), pa.array(size, pa.int64()), long(np.array(a, dtype=_U)), long(np.array(b, dtype=_U))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "row_id", "size", "print_a", "print_b"])

    return docs.mapInArrow(run, "doc_id long, digest long, row_id long, size long, print_a long, print_b long")


def _places(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mix(ids ^ _U(seed)) >> _U(64 - bits)).astype(np.int64) for seed in (0x51ED270B, 0xA24BAED4, 0x9FB21C65)]


def bloom(ids: DataFrame, bits: int = BLOOM_BITS) -> np.ndarray:
    """A Bloom filter of a column of longs, as 64-bit words. It always has 2 ** ``bits`` bits (16 MB), however many ids there are:
    too many make it useless, not larger and not wrong."""

    def run(batches):
        words = np.zeros(1 << (bits - 6), dtype=_U)
        for batch in batches:
            for at in _places(batch.column(0).to_numpy().view(_U), bits):
                np.bitwise_or.at(words, at >> 6, _U(1) << (at & 63).astype(_U))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), long(words[used])], names=["word", "mask"])

    found = ids.mapInArrow(run, "word int, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=_U)
    out[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(_U)
    return out


def _among(ids: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which ids the filter lets pass."""
    bits = len(words).bit_length() - 1 + 6
    out = np.ones(len(ids), dtype=bool)
    for at in _places(ids, bits):
        out &= (words[at >> 6] >> (at & 63).astype(_U)) & _U(1) != 0
    return out


def _with_row_ids(docs: DataFrame, chosen: DataFrame, n: int) -> DataFrame:
    """(row_id, text) of rows of (doc_id, text) that are in ``chosen`` (id, doc_id), and of a few others. The filter stands where
    the texts are read, so they are not shuffled."""
    context = docs.sparkSession.sparkContext
    filters = [context.broadcast(bloom(chosen.select(c))) for c in ("doc_id", "id")]

    def run(batches):
        of_doc, of_row = (f.value for f in filters)
        for batch in batches:
            some = batch.filter(pa.array(_among(batch.column(0).to_numpy().view(_U), of_doc)))
            for keys, raw in slices([some]):
                rows = _row_ids(keys, list(ngram_sets(raw, n)))[0]
                hit = np.flatnonzero(_among(rows, of_row))
                yield pa.RecordBatch.from_arrays([long(rows[hit]), pa.array([raw[i] for i in hit], pa.binary()).cast(pa.string())], names=["row_id", "text"])

    return docs.mapInArrow(run, "row_id long, text string")


def _holders(docs: DataFrame, n: int, classes: int) -> DataFrame:
    """(gram, row_id) of the n-grams of one of ``classes`` hash classes; ``docs`` has doc_id or row_id, and the text."""
    named = docs.columns[0] == "row_id"

    def run(batches):
        for keys, raw in slices(batches):
            sets = list(ngram_sets(raw, n))
            rows = np.array(keys, dtype=np.int64).view(_U) if named else _row_ids(keys, sets)[0]
            chosen = [own[(own >> _U(20)) % _U(classes) == 0] for own in sets]
            yield pa.RecordBatch.from_arrays([long(np.concatenate(chosen)), long(np.repeat(rows, [len(c) for c in chosen]))], names=["gram", "row_id"])

    return docs.mapInArrow(run, "gram long, row_id long")


def _own(held: DataFrame) -> DataFrame:
    """(id, own): how many n-grams (gram, low, high: smallest and largest row) no other row has. Repeated rows are one row."""
    return held.where("low = high").groupBy(F.col("low").alias("id")).agg(F.count("*").alias("own"))


def _hot(held: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams of the stored counts and their counts, by n-gram: ``MOST_HOT`` at most."""
    often = held.where(F.col("n") >= HELD_OFTEN)
    least, total = HELD_OFTEN, 0
    for row in sorted(often.groupBy("n").agg(F.count("*").alias("grams")).collect(), key=lambda r: -r["n"]):
        total += row["grams"]
        if total > MOST_HOT:
            least = row["n"] + 1
            break
    found = often.where(F.col("n") >= least).select("gram", "n").collect()
    grams = np.array([r["gram"] for r in found], dtype=np.int64).view(_U)
    order = np.argsort(grams)
    return grams[order], np.array([r["n"] for r in found], dtype=np.int64)[order]


_BITS = [f"bits{k}" for k in range(WORDS_OF_BITS)]


def features(docs: DataFrame, chosen: DataFrame, n: int = N) -> DataFrame:
    """Per row of (row_id, text) in ``chosen`` (row_id), once: its set and the bitmap of parities."""
    width = 64 * WORDS_OF_BITS
    sent = docs.sparkSession.sparkContext.broadcast(bloom(chosen))

    def run(batches):
        for batch in batches:
            some = batch.filter(pa.array(_among(batch.column(0).to_numpy().view(_U), sent.value)))
            for keys, raw in slices([some]):
                sets = list(ngram_sets(raw, n))
                bits = [np.packbits((np.bincount((own & _U(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)).view(np.int64) for own in sets]
                arrays = [pa.array(keys, pa.int64()), pa.array([len(own) for own in sets], pa.int64()), pa.array([own.tobytes() for own in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(column) for column in np.stack(bits).T.copy()], names=["row_id", "size", "grams", *_BITS])

    made = docs.mapInArrow(run, "row_id long, size long, grams binary, " + ", ".join(f"{b} long" for b in _BITS))
    return made.join(chosen, "row_id", "left_semi").dropDuplicates(["row_id"])


def prefixes(sets: DataFrame, hot: tuple[np.ndarray, np.ndarray], least: int) -> DataFrame:
    """(id, size, pos, gram) of the shared n-grams in the prefix of each set (id, size, grams, own: its own n-grams), rare first;
    its own n-grams take the first places."""
    sent = sets.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        grams_hot, counts_hot = sent.value
        for batch in batches:
            places, grams, counts = [], [], []
            for size, whole, single in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                own = np.frombuffer(whole.as_py(), dtype=_U)
                shared = np.setdiff1d(own, np.array(single or [], dtype=np.int64).view(_U), assume_unique=True)
                begin = size - len(shared)
                place = np.searchsorted(grams_hot, shared)
                known = place < len(grams_hot)
                known[known] = grams_hot[place[known]] == shared[known]
                count = np.zeros(len(shared), dtype=np.int64)
                count[known] = counts_hot[place[known]]
                first = shared[np.argsort(count, kind="stable")[: max(0, prefix_length(size, least) - begin)]]
                grams.append(first)
                places.append(np.arange(begin, begin + len(first)))
                counts.append(len(first))
            if counts:
                taken = pa.array(np.repeat(np.arange(len(counts)), counts))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(1).take(taken), pa.array(np.concatenate(places).astype(np.int64)), long(np.concatenate(grams))], names=["id", "size", "pos", "gram"])

    return sets.mapInArrow(run, "id long, size long, pos long, gram long")


# ---------------------------------------------------------------- candidates


def _may_link(a: str, b: str, least: int) -> Column:
    """Length, positional and suffix filters for rows ``a`` and ``b`` that share a prefix n-gram; all three are bounds."""
    def c(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    both = c(a, "size") + c(b, "size")
    length = (c(a, "size") * 100 >= c(b, "size") * least) & (c(b, "size") * 100 >= c(a, "size") * least)
    shared = F.least(c(a, "pos"), c(b, "pos")) + 1 + F.least(c(a, "size") - c(a, "pos"), c(b, "size") - c(b, "pos")) - 1
    positional = shared * (100 + least) >= both * least
    apart = sum((F.bit_count(c(a, k).bitwiseXOR(c(b, k))) for k in _BITS), F.lit(0))
    suffix = apart * (100 + least) <= both * (100 - least)
    return length & positional & suffix


def _verified(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    ids = store(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ngram-pair-ids")
    needed = sets.select("id", "grams").join(ids, "id", "left_semi")
    left = needed.select(F.col("id").alias("a"), F.col("grams").alias("grams_a"))
    right = needed.select(F.col("id").alias("b"), F.col("grams").alias("grams_b"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_py(), dtype=_U), np.frombuffer(y.as_py(), dtype=_U)
                same = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * same >= least * (len(p) + len(q) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "grams_a", "grams_b").mapInArrow(run, "a long, b long")


def _pairs(joined: DataFrame, a: str, b: str) -> DataFrame:
    return joined.select(F.least(f"{a}.id", f"{b}.id").alias("a"), F.greatest(f"{a}.id", f"{b}.id").alias("b")).distinct()


def _grouped(docs: DataFrame, n: int, least: int) -> DataFrame:
    """Per row of (doc_id, text, digest): doc_id, digest, row_id, size, and of its component the smallest doc_id (component_id) and
    one row of a set (leader_id) that stands for it."""
    prints = ["size", "print_a", "print_b"]
    made = store(fingerprints(docs, n), "ngram-prints")
    full = made.where("size > 0 AND doc_id IS NOT NULL")
    # Equal sets are one set from here on, named by one of their rows.
    leaders = full.groupBy(*prints).agg(F.min("row_id").alias("id"), F.min_by("doc_id", "row_id").alias("of_doc"), F.min("doc_id").alias("least_doc"))
    leaders = store(leaders, "ngram-leaders")
    longest = F.col("size") - F.ceil(F.col("size") * least / 100) + 1

    named = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    sample = _holders(named, n, CLASSES).groupBy("gram").agg(F.min("row_id").alias("low"), F.max("row_id").alias("high"))
    unsure = store(leaders.join(_own(sample), "id", "left").where(F.coalesce("own", F.lit(0)) < longest).select("id", "size", F.col("of_doc").alias("doc_id")), "ngram-unsure")
    unsure_texts = store(_with_row_ids(named, unsure.select("id", "doc_id"), n), "ngram-texts")
    held = _holders(unsure_texts, n, 1).groupBy("gram").agg(F.count("*").alias("n"), F.min("row_id").alias("low"), F.max("row_id").alias("high"))
    held = store(held.where((F.col("low") == F.col("high")) | (F.col("n") >= HELD_OFTEN)), "ngram-held")
    still = store(unsure.join(_own(held), "id", "left").where(F.coalesce("own", F.lit(0)) < longest).select(F.col("id").alias("row_id")), "ngram-still")
    sets = store(features(unsure_texts, still, n).withColumnRenamed("row_id", "id"), "ngram-sets")
    alone = held.where("low = high").select(F.col("low").alias("row_id"), "gram").join(still, "row_id", "left_semi").groupBy(F.col("row_id").alias("id")).agg(F.collect_list("gram").alias("own"))
    rows = store(prefixes(sets.select("id", "size", "grams").join(alone, "id", "left").select("id", "size", "grams", "own"), _hot(held), least), "ngram-prefixes")
    discard(unsure, unsure_texts, held, still)

    often = rows.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    narrow = store(rows.join(often, "gram", "left_semi"), "ngram-met")  # prefix n-grams of at least two sets
    discard(rows)
    central = narrow.groupBy("id", "size").agg(F.count("*").alias("n")).select("id", (F.col("n") / longest).alias("central"))
    met = store(narrow.join(central, "id").join(sets.select("id", *_BITS), "id"), "ngram-rows")
    discard(narrow)

    hubs = met.groupBy("gram").agg(F.max(F.struct("central", "id", "size", "pos", *_BITS)).alias("h"))
    hubs = hubs.select("gram", *[F.col(f"h.{c}").alias(c) for c in ("id", "size", "pos", *_BITS)])
    x, y = met.alias("x"), hubs.alias("y")
    starred = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.id") != F.col("y.id")) & _may_link("x", "y", least))
    links = store(_verified(store(_pairs(starred, "x", "y"), "ngram-star"), sets, least), "ngram-links")
    parts = components(links)

    placed = met.join(parts.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = store(placed, "ngram-placed")
    discard(met)
    open_grams = placed.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max(F.struct("central", "id", "component")).alias("h"))
    open_grams = open_grams.where("low < high").select("gram", F.col("h.component").alias("main"))
    still = store(placed.join(open_grams, "gram"), "ngram-open")
    x, y = still.where("component != main").alias("x"), still.alias("y")
    across = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.component") != F.col("y.component")) & _may_link("x", "y", least))
    more = store(_verified(store(_pairs(across, "x", "y"), "ngram-across"), sets, least), "ngram-more")
    discard(sets, placed, still)
    if not more.isEmpty():
        parts = components(parts.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    final = leaders.join(parts.withColumnRenamed("node", "id"), "id", "left").select(*prints, "id", "least_doc", F.coalesce("component", "id").alias("component"))
    final = store(final, "ngram-final")
    first = final.groupBy("component").agg(F.min("least_doc").alias("component_id"), F.min_by("id", F.struct("least_doc", "id")).alias("leader"))
    of_set = final.join(first, "component").select(*prints, "id", "leader", "component_id")
    joined = made.join(of_set, prints, "left")
    alone = (F.col("size") == 0) | F.col("doc_id").isNull()
    return joined.select(
        "doc_id", "digest", "size", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | ((F.col("doc_id") == F.col("component_id")) & (F.col("id") == F.col("leader")))).alias("stays"),
    )


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return texts(docs, id_col, text_col).withColumn("digest", F.xxhash64("text"))


def classes(docs: DataFrame, n: int = N, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id that links reach, itself included).

    Two documents link when their sets of ``n``-grams have a Jaccard similarity of ``least`` percent or more. A document
    without words (null, empty or blank text) has an empty set and links with nothing. A row without an id links with
    nothing and has no component. Rows that share an id are linked by their own texts, each with its own component. Very long
    texts are read whole; other columns are not read, so their names can't clash. An empty table gives no rows.
    """
    return _grouped(_read(docs, id_col, text_col), n, least).select("doc_id", F.col("size").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, n: int = N, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, of the smallest id, all columns unchanged; documents without an id or without
    words stay. Rows alike in id and text share one decision; other rows that share an id are decided one by one."""
    gone = store(_grouped(_read(docs, id_col, text_col), n, least).where("NOT stays").select(F.col("doc_id").alias("_gone"), F.col("digest").alias("_gone_digest")).distinct(), "ngram-gone")
    digest = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return docs.join(gone, (docs[id_col].cast("long") == gone["_gone"]) & (digest == gone["_gone_digest"]), "left_anti")


@query("op9_ngram_join")
def op9_ngram_join(spark, sf_dir):
    return classes(table(spark, sf_dir, "documents"))
