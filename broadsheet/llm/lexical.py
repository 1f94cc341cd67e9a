"""Ranked lexical search by impact-sorted lists read without random access (NRA).

One pass over the documents counts their terms and keeps, per document, the terms that some item of the block asks for. From
its sums come the number of documents, of terms, and each term's document frequency, and with them every posting's exact
contribution to a score. A second pass reads the kept terms in shards of bounded size: a shard's posting lists are sorted by
contribution and read sequentially, all lists down to the same level, then to the next. Every document met has a score
interval: what was read of it, and that plus the highest unread contribution of each term not yet seen in it. Reading goes on
until no unseen document can enter, no other document's upper end reaches the last place (equality counts, so ties are
resolved), and the interval of every document that stays has closed to its score. Shards of a task hand their best on; Spark
merges the best of all tasks.

Items are taken in blocks of bounded size, so what tasks are sent does not grow with the number of items.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import discard, store, table, text_bytes
from .queries import query

PLACES = 50
#: Document length normalisation in percent, term saturation, and the scale of impacts (fixed values of the score).
SLOPE, SATURATION, UNIT = 50, 20, 1000
#: Most characters of item texts that are sent to tasks at once.
BLOCK_CHARS = 4 << 20
#: Postings of a shard.
SHARD = 4 << 20
#: Each level is this share of the one before.
LEVEL = 0.6

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms(raw: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of ASCII letters, digits and characters above U+007F, with A-Z lower-cased."""
    return _TERM.findall(raw.lower())


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


# ---------------------------------------------------------------- one shard


class Shard:
    """Posting lists of some documents, each sorted by contribution, highest first."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, gain: np.ndarray, docs: int):
        order = np.lexsort((-gain, term))
        self.docs, self.doc, self.gain = docs, doc[order], gain[order]
        self.term, first = np.unique(term[order], return_index=True)
        self.ends = np.append(first, len(order))

    def lists(self, wanted: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(documents, contributions) of those of the ``wanted`` terms that occur here."""
        at = np.searchsorted(self.term, wanted)
        at = at[(at < len(self.term)) & (self.term[np.minimum(at, len(self.term) - 1)] == wanted)] if len(self.term) else at[:0]
        return [(self.doc[self.ends[i] : self.ends[i + 1]], self.gain[self.ends[i] : self.ends[i + 1]]) for i in at]


def resolve(lists, docs: int, places: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Documents that can be among the best ``places`` and their exact scores, by sequential reads of impact-sorted lists.

    ``floor`` is a score that ``places`` documents elsewhere reach: lower scores are of no use. Each round reads all lists on
    down to a level. Below it, a list holds at most level - 1, or its first entry if that is less, or nothing more.
    """
    empty = np.empty(0, dtype=np.int64)
    if not lists:
        return empty, empty
    doc, gain = np.concatenate([d for d, _ in lists]), np.concatenate([g for _, g in lists])
    order = np.argsort(-gain, kind="stable")
    doc, fall = doc[order], -gain[order]
    heads, ends = np.array([g[0] for _, g in lists]), np.array([g[-1] for _, g in lists])
    low = np.zeros(docs, dtype=np.int64)  # the lower end of each document's interval
    seen = np.zeros(docs, dtype=np.int64)  # lists with unread entries in which the document was met
    going = np.ones(len(lists), dtype=bool)
    found, growing = empty, True  # documents in question; whether unseen ones may still enter
    at, level = 0, int(heads.max()) + 1
    while True:
        level = int(level * LEVEL)
        stop = int(np.searchsorted(fall, -level, side="right"))
        new = doc[at:stop]
        np.add.at(low, new, -fall[at:stop])
        np.add.at(seen, new, 1)
        at = stop
        over = going & (ends >= level)
        for i in np.flatnonzero(over):
            seen[lists[i][0]] -= 1
        going &= ~over
        if growing:
            found = np.flatnonzero(low)
        bound = int(np.minimum(level - 1, heads[going]).sum())
        least = floor
        if len(found) >= places:
            least = max(least, int(np.partition(low[found], len(found) - places)[len(found) - places]))
        high = low[found] + bound - seen[found] * max(level - 1, 0)
        stays = high >= least
        if growing and bound >= least and going.any():
            continue
        found, high = found[stays], high[stays]
        if growing:  # from here on only the entries of these documents count
            growing = False
            mine = np.zeros(docs, dtype=bool)
            mine[found] = True
            rest = mine[doc[at:]]
            doc, fall, at = doc[at:][rest], fall[at:][rest], 0
        if not going.any() or (high == low[found]).all():
            return found, low[found]


# ---------------------------------------------------------------- a block of items


def _count(docs: DataFrame, id_col: str, text_col: str, number: dict[bytes, int]) -> DataFrame:
    """Per document with a term: doc_id, n (its terms), and which of the block's terms it holds how often."""

    def run(batches):
        for batch in batches:
            ids, ns, ends, held, times = [], [], [0], [], []
            for key, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                found = terms(raw)
                if not found:
                    continue
                own: dict[int, int] = {}
                for t in found:
                    k = number.get(t)
                    if k is not None:
                        own[k] = own.get(k, 0) + 1
                ids.append(key)
                ns.append(len(found))
                held.extend(own.keys())
                times.extend(own.values())
                ends.append(len(held))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(held, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
                names=["doc_id", "n", "term", "tf"],
            )

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return own.mapInArrow(run, "doc_id long, n long, term array<int>, tf array<int>")


def _sums(counted: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and the document frequency of each of the block's terms."""

    def run(batches):
        total, docs, frequency = 0, 0, np.zeros(size, dtype=np.int64)
        for batch in batches:
            docs += batch.num_rows
            total += int(batch.column(0).to_numpy().sum())
            frequency += np.bincount(batch.column(1).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(frequency)
        yield pa.RecordBatch.from_pydict({"k": pa.array(np.concatenate([[-1, -2], at])), "v": pa.array(np.concatenate([[docs, total], frequency[at]]).astype(np.int64))})

    found = {r["k"]: r["v"] for r in counted.select("n", "term").mapInArrow(run, "k long, v long").groupBy("k").agg(F.sum("v").alias("v")).collect()}
    return found.get(-1, 0), found.get(-2, 0), np.array([found.get(k, 0) for k in range(size)], dtype=np.int64)


def _shards(batches, most: int):
    """Rows of ``counted`` in shards of about ``most`` postings; a document is never divided."""
    some, size = [], 0
    for batch in batches:
        at = 0
        ends = batch.column(2).offsets.to_numpy()
        while at < batch.num_rows:
            room = max(at + 1, int(np.searchsorted(ends - ends[at], most - size, side="right")) - 1)
            stop = min(batch.num_rows, room)
            some.append(batch.slice(at, stop - at))
            size += int(ends[stop] - ends[at])
            at = stop
            if size >= most or at < batch.num_rows:
                yield pa.Table.from_batches(some).combine_chunks()
                some, size = [], 0
    if some:
        yield pa.Table.from_batches(some).combine_chunks()


def _best(counted: DataFrame, wanted: list[np.ndarray], weights: np.ndarray, documents: int, total: int, places: int, shard_size: int) -> DataFrame:
    """(item, doc_id, score): for each item the best of each task, equal scores by ascending doc_id, rows without an id last."""

    def run(batches):
        kept: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(wanted)
        missing = np.iinfo(np.int64).max
        for rows in _shards(batches, shard_size):
            ids = rows.column("doc_id").combine_chunks().fill_null(missing).to_numpy()
            n = rows.column("n").to_numpy()
            held, tf = rows.column("term").combine_chunks(), rows.column("tf").combine_chunks().flatten().to_numpy().astype(np.int64)
            sizes = np.diff(held.offsets.to_numpy())
            length = 100 - SLOPE + (SLOPE * n * documents) // total
            doc = np.repeat(np.arange(len(n)), sizes)
            term = held.flatten().to_numpy().astype(np.int64)
            gain = weights[term] * ((UNIT * UNIT * 1000 * tf) // (UNIT * tf + SATURATION * length[doc]))
            some = gain > 0
            shard = Shard(term[some], doc[some], gain[some], len(n))
            for item, own in enumerate(wanted):
                had_ids, had = kept[item]
                floor = int(had.min()) if len(had) >= places else 0
                found, score = resolve(shard.lists(own), shard.docs, places, floor)
                all_ids, all_scores = np.concatenate([had_ids, ids[found]]), np.concatenate([had, score])
                order = np.lexsort((all_ids, -all_scores))[:places]
                kept[item] = all_ids[order], all_scores[order]
        item = np.repeat(np.arange(len(wanted)), [len(k[0]) for k in kept]).astype(np.int32)
        ids = np.concatenate([k[0] for k in kept]) if kept else np.empty(0, np.int64)
        score = np.concatenate([k[1] for k in kept]) if kept else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=ids == missing), pa.array(score)], names=["item", "doc_id", "score"])

    return counted.select("doc_id", "n", "term", "tf").mapInArrow(run, "item int, doc_id long, score long")


def _search_block(docs: DataFrame, block: list, places: int, shard_size: int, id_col: str, text_col: str) -> DataFrame:
    number: dict[bytes, int] = {}
    wanted = []
    for row in block:
        own = {number.setdefault(t, len(number)) for t in terms((row["text"] or "").encode())}
        wanted.append(np.array(sorted(own), dtype=np.int64))
    counted = store(_count(docs, id_col, text_col, number), "lexical-terms")
    documents, total, frequency = _sums(counted, len(number))
    weights = np.array([weight(documents, int(f)) if documents else 0 for f in frequency], dtype=np.int64)
    per_task = store(_best(counted, wanted, weights, documents, total, places, shard_size), "lexical-best")
    discard(counted)
    # The last place of a task that filled all places is a floor for every other task's rows.
    floors = per_task.groupBy("item", F.spark_partition_id()).agg(F.count("*").alias("n"), F.min("score").alias("last"))
    floors = floors.where(F.col("n") >= places).groupBy(F.col("item").alias("_item")).agg(F.max("last").alias("floor"))
    names = docs.sparkSession.createDataFrame([(k, r["item_id"]) for k, r in enumerate(block)], "item int, item_id long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    some = per_task.join(floors, per_task["item"] == floors["_item"], "left").where("floor IS NULL OR score >= floor")
    best = some.select("item", "doc_id", "score", F.row_number().over(order).alias("rank")).where(F.col("rank") <= places)
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, places: int = PLACES, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS, shard_size: int = SHARD) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``places`` best documents of each item with a score above 0.

    Equal scores are ranked by ascending doc_id. A null or empty text, of a document or an item, has no terms: such documents
    are not counted, such items get no rows. Each row of ``docs`` is a document, also when rows share an id or repeat; rows
    without an id rank behind others of the same score. Each row of ``items`` is ranked on its own, so rows that share an
    item_id give several lists under it. Very long texts are counted whole. An empty table on either side gives no rows. Other
    columns are not read.
    """
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    size = asked.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_chars))
    out = None
    for k in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        if block:
            made = _search_block(docs, block, places, shard_size, id_col, text_col)
            out = made if out is None else out.unionByName(made)
    return out if out is not None else items.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")


# ---------------------------------------------------------------- query

_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

SQL = f"""WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents WHERE text IS NOT NULL),
q AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark WHERE text IS NOT NULL),
sizes AS (SELECT count(*) AS n_docs, sum(len(words)) AS n_terms FROM d WHERE len(words) > 0),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM d) GROUP BY 1, 2, 3),
asked AS (SELECT * FROM tf WHERE term IN (SELECT term FROM q)),
df AS (SELECT term, count(*) AS df FROM asked GROUP BY 1),
gains AS (SELECT a.doc_id, a.term, CAST(floor(1000 * ln((2 * s.n_docs + 2)::DOUBLE / (2 * f.df + 1))) AS BIGINT)
  * ((1000000000 * a.tf) // (1000 * a.tf + 20 * (100 - 50 + ((50 * a.n * s.n_docs) // s.n_terms)))) AS gain
  FROM asked a JOIN df f ON a.term = f.term CROSS JOIN sizes s),
scores AS (SELECT q.item_id, g.doc_id, CAST(sum(g.gain) AS BIGINT) AS score FROM q JOIN gains g ON q.term = g.term GROUP BY 1, 2),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""


@query("op12_lexical_search", SQL)
def op12_lexical_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
