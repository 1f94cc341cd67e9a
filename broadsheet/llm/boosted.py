"""Quality scores from histogram gradient-boosted trees over document statistics.

Statistics come from the bytes and word fingerprints of a text, a batch of texts at a time. Trees are grown level by level
on a bounded sample of labelled rows, with the statistics cut into bins, and kept as flat arrays: a batch of documents
walks down all trees with one array look-up per level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import combine, doc_words, slices, store, table, texts
from .labels import labelled, remainder
from .queries import query

#: Labelled rows of each class that the trees are grown on.
SAMPLE = 8000
BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.2
SHRINK = 1.0

#: Byte classes that are counted.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#*$%&|<>", "shout": b"!?", "stop": b".,;:",
    "line": b"\n", "bracket": b"()[]{}", "quote": b"\"'`", "other_ascii": b"@~^_=+/\\-",
}
NAMES = [
    "words", "chars_per_word", "words_per_line", *CLASSES, "above_ascii", "distinct_words", "top_word", "same_neighbour", "repeated_triples", "repeated_lines", "longest_word",
]


def _repeated(values: np.ndarray) -> float:
    """Share of values that occur more than once."""
    if not len(values):
        return 0.0
    _, n = np.unique(values, return_counts=True)
    return float(n[n > 1].sum()) / len(values)


def statistics(raw: list[bytes]) -> np.ndarray:
    """One row of statistics per text; shares are per word, so that they do not grow with the text."""
    out = np.zeros((len(raw), len(NAMES)))
    offsets, (words,) = doc_words(raw)
    lookup = np.zeros(256, dtype=np.int64)
    for k, members in enumerate(CLASSES.values()):
        lookup[list(members)] = k + 1
    for i, r in enumerate(raw):
        own = words[offsets[i] : offsets[i + 1]]
        n = len(own)
        if not n:
            continue
        data = np.frombuffer(r, dtype=np.uint8)
        counts = np.bincount(lookup[data], minlength=len(CLASSES) + 1)[1:]
        lines = [x for x in r.split(b"\n") if x.strip()]
        _, often = np.unique(own, return_counts=True)
        triples = combine([own[:-2], own[1:-1], own[2:]]) if n > 2 else own[:0]
        out[i] = [
            np.log1p(n), len(data) / n, n / max(1, len(lines)), *(counts / n), (data > 127).sum() / n, len(often) / n, often.max() / n,
            (own[1:] == own[:-1]).sum() / n, _repeated(triples), 1 - len(set(lines)) / max(1, len(lines)), max(map(len, r.split())),
        ]
    return out


# ---------------------------------------------------------------- trees


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth as arrays: per tree and inner node the statistic and its bound, per leaf the value."""

    start: float
    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > bound[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boosted trees for labels 0 and 1 under the logistic loss. Every split is the best over all bins of all statistics."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    n_features = x.shape[1]
    share = float(np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    start = float(np.log(share / (1 - share)))
    total = np.full(len(y), start)
    features, bounds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, curve = weight * (y - p), weight * p * (1 - p)
        feature = np.zeros(2**depth - 1, dtype=np.int64)
        bound = np.full(2**depth - 1, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = (node - first) * BINS
            best = np.zeros(width)
            for f in range(n_features):
                place = at + binned[:, f]
                g = np.bincount(place, weights=gradient, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1)
                h = np.bincount(place, weights=curve, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1)
                gain = g**2 / (h + SHRINK) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + SHRINK) - g[:, -1:] ** 2 / (h[:, -1:] + SHRINK)
                cut = gain[:, : len(edges[f])].argmax(axis=1) if len(edges[f]) else np.zeros(width, dtype=np.int64)
                value = gain[np.arange(width), cut] if len(edges[f]) else np.zeros(width)
                for k in np.flatnonzero(value > best + 1e-9):
                    best[k] = value[k]
                    feature[first + k], bound[first + k] = f, edges[f][cut[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > bound[node])
        ends = node - (2**depth - 1)
        leaf = RATE * np.bincount(ends, weights=gradient, minlength=2**depth) / (np.bincount(ends, weights=curve, minlength=2**depth) + SHRINK)
        total += leaf[ends]
        features.append(feature)
        bounds.append(bound)
        leaves.append(leaf)
    return Forest(start, np.array(features), np.array(bounds), np.array(leaves))


# ---------------------------------------------------------------- operator


def train(docs: DataFrame, labels: DataFrame, training) -> Forest:
    """Trees from at most ``SAMPLE`` labelled rows of each class; a class that is cut weighs as much as all its rows."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).where(training(F.col("doc_id")))
    size = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.countDistinct("doc_id").alias("n")).collect()}
    columns = ", ".join(f"x{k} double" for k in range(len(NAMES)))

    def run(batches):
        for batch in batches:
            x = statistics([(t or "").encode() for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(2), *[pa.array(c) for c in x.T.copy()]], names=["label", *[f"x{k}" for k in range(len(NAMES))]])

    sample = labelled(docs, labels, "quality", training, SAMPLE).select("doc_id", "text", F.col("quality").alias("label")).orderBy("doc_id")
    rows = store(sample, "quality-sample").mapInArrow(run, "label int, " + columns).collect()  # 2 * SAMPLE rows of numbers
    y = np.array([r[0] for r in rows], dtype=float)
    if len(set(y)) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        return Forest(float(np.log(share / (1 - share))), np.empty((0, 1), int), np.empty((0, 1)), np.empty((0, 2)))
    x = np.array([r[1:] for r in rows])
    drawn = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    return grow(x, y, np.where(y == 1, size.get(1, 0) / drawn[1], size.get(0, 0) / drawn[0]))


def score(docs: DataFrame, labels: DataFrame, training=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and score, the probability that ``labels.quality`` is 1.

    Rows of ``labels`` that ``training`` does not select are never learned from. Null, empty and blank texts have statistics
    of zero and are scored as such. Rows that repeat are scored alike, an empty table gives no rows, and with labels of one
    class only (or none) every text gets the share of that class.
    """
    base = texts(docs, id_col, text_col)
    forest = train(base, labels, training or (lambda c: F.lit(True)))

    def run(batches):
        for ids, raw in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(forest.score(statistics(raw)))], names=["doc_id", "score"])

    return base.mapInArrow(run, "doc_id long, score double")


HELD_OUT = 4


@query("op8_quality_classifier")
def op8_quality_classifier(spark, sf_dir):
    training = lambda doc_id: remainder(doc_id, HELD_OUT) != 2
    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), training)
    held_out = F.coalesce(remainder(F.col("doc_id"), HELD_OUT) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
