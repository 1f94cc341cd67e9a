"""Nearest neighbours by a robust-pruned directed graph per shard.

Vectors are dealt to shards by a hash, so every shard looks like the whole. A shard's graph grows in batches that double: a
greedy beam search from the centre proposes neighbours for every vector of the batch, relaxed distance pruning keeps an edge
unless a kept one is nearer to its target by the factor ``ALPHA`` (so edges stay diverse), and targets link back under the same
rule. Nodes that no path reaches get an extra edge from their nearest reachable node. A query runs a beam search in each shard;
the best of all shards answer. Equal vectors are one node, which keeps the smallest ids that an answer can hold.

The index is a table of nodes with their edges in the shared folder. Queries meet it in blocks; no task sees more than one
shard and one block, whatever the size of either side.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import discard, store, table
from .codes import usable
from .queries import query

NEAREST = 10
#: Nodes of a shard, edges of a node, entries of the beam while building and while searching.
SHARD, DEGREE, BEAM, SEARCH_BEAM = 8192, 32, 64, 128
ALPHA = 1.2
#: Most vectors that enter a graph at once, queries that meet a shard at once, and query rows of a block.
BATCH, TOGETHER, BLOCK = 512, 256, 4096
#: Nodes that a search step opens.
OPENED = 4


# ---------------------------------------------------------------- one shard


class Space:
    """Vectors of a shard, scaled to at most 1 and with a far-away last row that pads lists of nodes. Single precision steers
    the search, double precision where vectors differ in size so much that squares of the small ones would vanish."""

    def __init__(self, vectors: np.ndarray):
        self.n = len(vectors)
        largest = np.abs(vectors).max(axis=1, initial=0)
        self.scale = float(largest.max(initial=0)) or 1.0
        kind = np.float32 if largest.min(initial=np.inf) > 1e-3 * self.scale else np.float64
        self.x = np.zeros((self.n + 1, vectors.shape[1]), dtype=kind)
        self.x[:-1] = vectors / self.scale
        self.norms = np.einsum("ij,ij->i", self.x, self.x)
        self.norms[-1] = np.inf

    def away(self, points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of ``points`` (b, d) to their ``nodes`` (b, c), less the square of the point."""
        return self.norms[nodes] - 2 * np.matmul(self.x[nodes], points[:, :, None])[:, :, 0]

    def centre(self) -> int:
        return int(self.away(self.x[:-1].mean(axis=0, dtype=np.float64).astype(self.x.dtype)[None], np.arange(self.n)[None]).argmin())


def beam_search(space: Space, edges: np.ndarray, start: int, points: np.ndarray, width: int, path: int = 0):
    """The ``width`` nearest nodes that a greedy search met for each point, their distances (see ``Space.away``), and the first
    nodes that it opened (at least ``path``, when it opened so many)."""
    b, none = len(points), space.n
    seen = np.zeros((b, none + 1), dtype=bool)
    ids = np.full((b, width), none, dtype=np.int64)
    dist = np.full((b, width), np.inf, dtype=space.x.dtype)
    closed = np.ones((b, width), dtype=bool)
    ids[:, 0], closed[:, 0], seen[:, start] = start, False, True
    dist[:, 0] = space.away(points, ids[:, :1])[:, 0]
    opened, steps = [], 0
    rows = np.arange(b)
    while len(rows):
        waiting = np.where(closed[rows], np.inf, dist[rows])
        pick = np.argpartition(waiting, OPENED, axis=1)[:, :OPENED] if width > OPENED else np.broadcast_to(np.arange(width), (len(rows), width))
        ready = np.isfinite(np.take_along_axis(waiting, pick, axis=1))
        live = ready.any(axis=1)
        rows, pick, ready = rows[live], pick[live], ready[live]
        if not len(rows):
            break
        nodes = np.where(ready, ids[rows[:, None], pick], none)
        closed[rows[:, None], pick] = True
        if steps < path:
            step = np.full((b, nodes.shape[1]), none, dtype=np.int64)
            step[rows] = nodes
            opened.append(step)
            steps += nodes.shape[1]
        met = edges[nodes].reshape(len(rows), -1)
        fresh = ~seen[rows[:, None], met]
        # A node met twice in one step is kept once: the first of equal neighbours after sorting.
        order = np.argsort(met, axis=1)
        met, fresh = np.take_along_axis(met, order, axis=1), np.take_along_axis(fresh, order, axis=1)
        fresh[:, 1:] &= met[:, 1:] != met[:, :-1]
        met = np.where(fresh, met, none)
        seen[rows[:, None], met] = True
        seen[:, none] = False
        all_ids = np.concatenate([ids[rows], met], axis=1)
        all_dist = np.concatenate([dist[rows], space.away(points[rows], met)], axis=1)
        all_closed = np.concatenate([closed[rows], met == none], axis=1)
        best = np.argpartition(all_dist, width - 1, axis=1)[:, :width]
        ids[rows], dist[rows], closed[rows] = (np.take_along_axis(a, best, axis=1) for a in (all_ids, all_dist, all_closed))
    return ids, dist, np.concatenate(opened, axis=1) if opened else np.empty((b, 0), dtype=np.int64)


def robust_prune(space: Space, points: np.ndarray, nodes: np.ndarray, degree: int, alpha: float = ALPHA) -> np.ndarray:
    """Up to ``degree`` of the candidate ``nodes`` (b, c) of each node in ``points`` (b): nearest first, and none that a kept
    one is nearer to than the point by the factor ``alpha``."""
    own = space.x[points]
    dist = space.away(own, nodes) + space.norms[points][:, None]
    dist = np.where(nodes == points[:, None], np.inf, np.maximum(dist, 0))
    order = np.argsort(dist, axis=1, kind="stable")
    nodes, dist = np.take_along_axis(nodes, order, axis=1), np.take_along_axis(dist, order, axis=1)
    x = space.x[nodes]
    norms = np.einsum("bcd,bcd->bc", x, x)
    between = norms[:, :, None] + norms[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
    alive = np.isfinite(dist)
    kept = np.full((len(points), degree), space.n, dtype=np.int64)
    rows = np.arange(len(points))
    for place in range(degree):
        first = alive.argmax(axis=1)
        there = alive[rows, first]
        if not there.any():
            break
        kept[there, place] = nodes[there, first[there]]
        same = nodes == nodes[rows, first][:, None]
        alive &= ~(there[:, None] & ((alpha * alpha * between[rows, first] <= dist) | same))
    return kept


def _link_back(space: Space, edges: np.ndarray, sources: np.ndarray, targets: np.ndarray, degree: int) -> None:
    """Add the edges target -> source; targets with too many edges are pruned."""
    order = np.lexsort((sources, targets))
    sources, targets = sources[order], targets[order]
    heads, first, count = np.unique(targets, return_index=True, return_counts=True)
    by_count = np.argsort(count, kind="stable")
    for at in range(0, len(heads), BATCH):
        some = by_count[at : at + BATCH]
        width = int(count[some].max())
        place = np.arange(width)[None, :]
        new = np.where(place < count[some][:, None], sources[np.minimum(first[some][:, None] + place, len(sources) - 1)], space.n)
        if width > 2 * degree:  # the nearest ones are all that pruning can keep
            near = np.argpartition(space.away(space.x[heads[some]], new), 2 * degree, axis=1)[:, : 2 * degree]
            new = np.take_along_axis(new, near, axis=1)
        both = np.concatenate([edges[heads[some], :degree], new], axis=1)
        both.sort(axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = space.n
        both.sort(axis=1)
        full = both.shape[1] > degree and (both[:, degree] < space.n)
        fits = some[~full] if both.shape[1] > degree else some
        edges[heads[fits], :degree] = both[~full][:, :degree]
        if both.shape[1] > degree and full.any():
            edges[heads[some[full]], :degree] = robust_prune(space, heads[some[full]], both[full], degree)


def _reach_all(space: Space, edges: np.ndarray, start: int) -> None:
    """Give every node that no path from ``start`` reaches an edge (the last column) from its nearest reachable node."""
    reached = np.zeros(space.n + 1, dtype=bool)
    reached[space.n] = True

    def spread(front: np.ndarray) -> None:
        while len(front):
            reached[front] = True
            front = np.unique(edges[front])
            front = front[~reached[front]]

    spread(np.array([start]))
    for node in np.flatnonzero(~reached):
        if not reached[node]:
            free = np.flatnonzero(reached[:-1] & (edges[:-1, -1] == space.n))
            nearest = free[space.away(space.x[node][None], free[None])[0].argmin()]
            edges[nearest, -1] = node
            spread(np.array([node]))


def build_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM) -> tuple[np.ndarray, int]:
    """Edges (n, degree + 1), padded with n, of distinct ``vectors`` (n, d), and the node where searches start. Two rounds: the
    second one offers every node neighbours from the whole graph."""
    space = Space(vectors)
    n, start = space.n, space.centre()
    edges = np.full((n + 1, degree + 1), n, dtype=np.int64)
    rest = np.random.default_rng(n).permutation(np.delete(np.arange(n), start))
    order = np.concatenate([[start], rest])
    clique = order[: degree + 1]
    for node in clique:
        edges[node, : len(clique) - 1] = clique[clique != node]
    at = len(clique)
    for whole in (False, True):
        while at < n:
            some = order[at : at + (BATCH if whole else min(at, BATCH))]
            ids, _, path = beam_search(space, edges, start, space.x[some], beam, degree)
            kept = robust_prune(space, some, np.concatenate([ids, path, edges[some]], axis=1), degree)
            edges[some, :degree] = kept
            there = kept < n
            _link_back(space, edges, np.repeat(some, degree)[there.ravel()], kept[there], degree)
            at += len(some)
        at = 0
    _reach_all(space, edges, start)
    return edges[:-1], start


def search_graph(vectors: np.ndarray, edges: np.ndarray, start: int, points: np.ndarray, width: int, wanted: int):
    """For each of ``points``: the ``wanted`` nearest nodes that the beam met and their exact distances, padded with n and inf."""
    space = Space(vectors)
    far = np.concatenate([edges, np.full((1, edges.shape[1]), space.n, dtype=edges.dtype)])
    out = []
    for at in range(0, len(points), TOGETHER):
        some = points[at : at + TOGETHER]
        near, _, _ = beam_search(space, far, start, (some / space.scale).astype(space.x.dtype), width)
        apart = vectors[np.minimum(near, space.n - 1)] - some[:, None, :]
        exact = np.where(near < space.n, np.sqrt((apart * apart).sum(axis=2)), np.inf)
        best = np.lexsort((near, exact), axis=1)[:, :wanted]
        out.append((np.take_along_axis(near, best, axis=1), np.take_along_axis(exact, best, axis=1)))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


# ---------------------------------------------------------------- the index


def _by_length(column: pa.ChunkedArray):
    """(places, float64 matrix) of each vector length in a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy()
    sizes, flat = np.diff(ends), column.values.to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        yield places, flat[ends[places][:, None] + np.arange(size)[None]].astype(np.float64)


def vectors_of(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct (vec_id, vec) that take part: an id, finite components only, and one that is not zero."""
    return usable(vectors, id_col, vec_col).where(F.col("vec_id").isNotNull() & F.exists("vec", lambda x: x != 0)).distinct()


def build_index(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", copies: int = NEAREST + 1, shard_rows: int = SHARD) -> DataFrame:
    """A stored table of nodes: shard, node, start (of the shard's vectors of that length), vec, ids, edges.

    A node is a distinct vector; ``ids`` are the ``copies`` smallest ids that have it, which is all that an answer of
    ``copies - 1`` others can hold. ``shard_rows`` is the intended size of a shard.
    """
    first = Window.partitionBy("vec").orderBy("vec_id")
    single = vectors_of(vectors, id_col, vec_col).withColumn("place", F.row_number().over(first)).where(F.col("place") <= copies)
    nodes = store(single.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "graph-nodes")
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.select("vec", "ids", F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int").alias("shard"))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort(rows.column("ids").combine_chunks().flatten().to_numpy()[rows.column("ids").combine_chunks().offsets.to_numpy()[:-1]], kind="stable")))
        out = []
        for places, matrix in _by_length(rows.column("vec")):
            edges, start = build_graph(matrix)
            some = rows.take(pa.array(places))
            n = len(places)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((edges < n).sum(axis=1))]).astype(np.int32)), pa.array(edges[edges < n].astype(np.int32)))
            out.append(pa.table({"shard": some.column("shard"), "node": pa.array(np.arange(n, dtype=np.int32)), "start": pa.array(np.full(n, start, dtype=np.int32)), "vec": some.column("vec"), "ids": some.column("ids"), "edges": lists}))
        return pa.concat_tables(out)

    kind = nodes.schema["vec"].dataType.simpleString()
    # A task per shard: shards are small, and by their size many of them would be put into one task.
    index = store(dealt.repartitionByRange(shards, "shard").groupBy("shard").applyInArrow(run, f"shard int, node int, start int, vec {kind}, ids array<bigint>, edges array<int>"), "graph-index")
    discard(nodes)
    index.shards = shards
    return index


def _met(index: DataFrame, asked: DataFrame, blocks: int, width: int, wanted: int) -> DataFrame:
    """(asked, vec_id, score): for each asked vector and shard the ``wanted`` nearest ids."""

    def run(nodes: pa.Table, points: pa.Table) -> pa.Table:
        out = [pa.table({"asked": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})]
        if nodes.num_rows and points.num_rows:
            by_size = {m.shape[1]: (p, m) for p, m in _by_length(points.column("vec"))}
            asked_ids = points.column("asked").to_numpy()
            for places, matrix in _by_length(nodes.column("vec")):
                if matrix.shape[1] not in by_size:
                    continue
                own = nodes.take(pa.array(places))
                node = own.column("node").to_numpy()
                order = np.argsort(node)
                own, matrix = own.take(pa.array(order)), matrix[order]
                lists, ids = own.column("edges").combine_chunks(), own.column("ids").combine_chunks()
                sizes = np.diff(lists.offsets.to_numpy())
                edges = np.full((len(matrix), max(1, int(sizes.max()))), len(matrix), dtype=np.int64)
                edges[np.arange(edges.shape[1])[None] < sizes[:, None]] = lists.flatten().to_numpy()
                which, vectors = by_size[matrix.shape[1]]
                near, exact = search_graph(matrix, edges, int(own.column("start")[0].as_py()), vectors, width, wanted)
                rows, cols = np.nonzero(near < len(matrix))
                starts, many = ids.offsets.to_numpy(), np.diff(ids.offsets.to_numpy())
                found = near[rows, cols]
                times = many[found]
                within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                row, score = np.repeat(rows, times), np.repeat(exact[rows, cols], times)
                vec_id = ids.values.to_numpy()[np.repeat(starts[found], times) + within]
                order = np.lexsort((vec_id, score, row))
                row, score, vec_id = row[order], score[order], vec_id[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                keep = place < wanted
                out.append(pa.table({"asked": pa.array(asked_ids[which[row[keep]]]), "vec_id": pa.array(vec_id[keep]), "score": pa.array(score[keep])}))
        return pa.concat_tables(out)

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = index.select("shard", "node", "start", "vec", "ids", "edges", every(blocks).alias("block"))
    right = asked.select("asked", "vec", F.pmod(F.xxhash64("asked"), F.lit(blocks)).cast("int").alias("block"), every(index.shards).alias("shard"))
    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(run, "asked long, vec_id long, score double")


def nearest(vectors: DataFrame, queries: DataFrame, index: DataFrame | None = None, k: int = NEAREST, width: int = SEARCH_BEAM, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of ``vectors`` for each row of ``queries``.

    Score is the Euclidean distance in double precision; ties go to the smaller vec_id. A row does not answer a query of its
    own id. Rows without an id, and vectors that are null, empty, zero or hold null or non-finite components, take no part
    (as vector or as query). Repeated rows count once; rows that share an id with different vectors are told apart, also as
    queries, whose answers then share the query_id. Vectors of another length than the query's are not near it. Fewer
    candidates give fewer rows, empty tables none. Other columns are not read. Answers are approximate: the tests measure the
    recall against brute force.
    """
    index = index if index is not None else build_index(vectors, id_col, vec_col, k + 1)
    rows = vectors_of(queries, id_col, vec_col).withColumnRenamed("vec_id", "query_id")
    asked = store(rows.groupBy("vec").agg(F.min("query_id").alias("asked"), F.count("*").alias("n")), "graph-queries")
    # Ids that several vectors share make "asked" ambiguous; the vector's hash tells them apart.
    asked = asked.select("vec", F.xxhash64("asked", "vec").alias("asked"))
    blocks = max(1, -(-asked.count() // BLOCK))
    met = _met(index, asked, blocks, max(width, k + 1), k + 1)
    best = Window.partitionBy("asked").orderBy("score", "vec_id")
    found = met.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).drop("place")
    who = rows.join(asked, "vec").select("query_id", "asked")
    ranks = Window.partitionBy("query_id", "asked").orderBy("score", "vec_id")
    answers = found.join(who, "asked").where("vec_id != query_id").withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    return answers.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


# ---------------------------------------------------------------- query


@query("op13_graph_neighbours")
def op13_graph_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))
