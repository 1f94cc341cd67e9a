"""Vector codes and graph search against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm import codes, graph

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])
CLASHING = ("part", "entry", "code", "error", "row", "shard", "vec", "_label", "query_id", "rank", "score", "ids")


def frame(spark, rows, clashing: bool = False):
    df = spark.createDataFrame(rows, VECTORS)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING]) if clashing else df


def vector(rng, n: int = 32, spread: float = 1.0) -> list[float]:
    return [float(np.float32(rng.gauss(0, spread))) for _ in range(n)]


# ---------------------------------------------------------------- codes


@pytest.mark.parametrize("width", [1, 4, 60])
@pytest.mark.parametrize("size", [5, 1 << 20, (1 << 28) - 1])
def test_products_are_exact(width, size):
    rng = random.Random(width + size)
    a = [[rng.choice((-size, size, rng.randint(-size, size))) for _ in range(width)] for _ in range(40)]
    b = [[rng.choice((-size, size, rng.randint(-size, size))) for _ in range(width)] for _ in range(30)]
    got = codes.exact_products(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64))
    assert got.tolist() == [[sum(x * y for x, y in zip(r, s)) for s in b] for r in a]
    bits = codes.limb_bits(width)
    assert width * (1 << bits) ** 2 < 1 << 53


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    k = len(kept[0][1]) // parts
    cut = [[v[p * k : p * k + k] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            out.append([min((sum((x - y) ** 2 for x, y in zip(c[p], e)), n) for n, e in enumerate(books[p])) for p in range(parts)])
        return out

    for _ in range(rounds):
        made = assign()
        for p in range(parts):
            for n in range(len(books[p])):
                own = [c[p] for c, m in zip(cut, made) if m[p][1] == n]
                if own:
                    books[p][n] = [sum(col) // len(own) for col in zip(*own)]
    made = assign()
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    by_label = {}
    for (_, _, label), m in zip(kept, made):
        by_label[label] = by_label.get(label, 0) + sum(d for d, _ in m)
    return sorted(((i, "".join(f"{n:02x}" for _, n in m), sum(d for d, _ in m), by_label[label], digest) for (i, _, label), m in zip(kept, made)), key=str)


def test_codes_equal_plain_python(spark):
    rng = random.Random(5)
    rows = [(k - 20, vector(rng, spread=rng.choice((0.1, 1, 3000))), rng.choice((None, 1, 1, 1, 2))) for k in range(150)]
    rows += [(500 + k, rows[3][1], None) for k in range(30)] + [(500, rows[3][1], None)]  # copies and a repeated row
    rows += [(900, None, 1), (901, [None] + vector(rng, 31), 1), (902, [float("nan")] + vector(rng, 31), 1), (903, [float("inf")] + vector(rng, 31), None)]
    got = codes.compress(frame(spark, rows, clashing=True).repartition(5))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_codes(rows)


def test_codes_of_few_none_and_odd_rows(spark):
    rng = random.Random(6)
    few = [(None, vector(rng), None), (3, vector(rng), 1), (1, vector(rng), 1)]
    got = sorted((tuple(r) for r in codes.compress(frame(spark, few)).collect()), key=str)
    assert len(got) == 3 and {r[0] for r in got} == {None, 1, 3}
    assert [r["error"] for r in codes.compress(frame(spark, few[1:])).collect()] == [0, 0]  # each row is its own entry
    assert codes.compress(frame(spark, [])).count() == 0
    assert codes.compress(frame(spark, [(1, None, 1)])).count() == 0
    assert [r["vec_id"] for r in codes.compress(frame(spark, [(1, vector(rng), 1), (2, vector(rng, 16), 1)])).collect()] == [1]
    with pytest.raises(ValueError):
        codes.compress(frame(spark, [(1, vector(rng, 20), 1)]))


# ---------------------------------------------------------------- graph


def brute(rows, queries, k=10):
    """query -> the exact nearest (distance, id) of other ids."""
    usable = sorted({(i, tuple(v)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    x = np.array([v for _, v in usable])
    out = {}
    for i, v in usable:
        if i in queries:
            away = np.sqrt(((x - np.array(v)) ** 2).sum(axis=1))
            out[i] = sorted((float(d), j) for d, (j, _) in zip(away, usable) if j != i)[:k]
    return out


def check_answers(got, want, k=10):
    """Ranks, order and scores are right; the share of true neighbours found."""
    by_query = {}
    for r in got:
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    assert set(by_query) == {q for q, w in want.items() if w}
    hits = 0
    for q, rows in by_query.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(want[q]) + 1))
        assert [r[1:] for r in rows] == sorted(r[1:] for r in rows) and len({r[2] for r in rows}) == len(rows) and q not in {r[2] for r in rows}
        hits += len({r[2] for r in rows} & {j for _, j in want[q]})
        exact = dict((j, d) for d, j in want[q])
        assert all(math.isclose(s, exact[j], rel_tol=1e-12, abs_tol=1e-15) for _, s, j in rows if j in exact)
    return hits / max(1, sum(map(len, want.values())))


def test_graph_recall_with_copies_and_odd_rows(spark):
    rng = random.Random(8)
    centres = [vector(rng, 24) for _ in range(12)]
    rows = [(k - 50, [float(np.float32(c + rng.gauss(0, 0.4))) for c in rng.choice(centres)], 1) for k in range(1500)]
    rows += [(5000 + k, rows[7][1], None) for k in range(700)] + [rows[7], rows[9]]  # one very common vector, repeated rows
    rows += [(9000, None, 1), (9100, [0.0] * 24, 1), (9200, [None] + [1.0] * 23, 1), (9300, [float("nan")] * 24, 1), (None, centres[0], 1), (9400, [], 1), (9500, [float(np.float32(1e30))] * 24, 1)]
    df = frame(spark, rows, clashing=True).repartition(6)
    index = graph.build_index(df, shard_rows=400)
    assert index.select("shard").distinct().count() > 2 and index.agg(F.count("*")).first()[0] == len({tuple(v) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    got = graph.nearest(df, df.where("vec_id % 100 = 0"), index).collect()
    want = brute(rows, {i for i, _, _ in rows if i is not None and i % 100 == 0})
    assert check_answers(got, want) >= 0.95
    common = [r for r in got if r["query_id"] == 5100]
    assert [r["vec_id"] for r in sorted(common, key=lambda r: r["rank"])] == [rows[7][0], *range(5000, 5009)] and {r["score"] for r in common} == {0.0}


def test_graph_of_few_rows_and_other_lengths(spark):
    rng = random.Random(9)
    rows = [(0, vector(rng, 8), 1), (1, vector(rng, 8), 1), (100, vector(rng, 8), 1), (200, vector(rng, 5), 1), (201, vector(rng, 5), 1), (300, vector(rng, 3), 1)]
    df = frame(spark, rows)
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in graph.nearest(df, df.where("vec_id % 100 = 0")).collect()}
    assert {q for q, _ in got} == {0, 100, 200} and got[200, 1] == 201 and len(got) == 5  # none of 300's length
    assert graph.nearest(frame(spark, []), frame(spark, [])).count() == 0
    assert graph.nearest(df, df.where("false")).count() == 0


def test_every_node_is_reached():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(300, 4)), rng.normal(size=(300, 4)) * 1e-3 + 50, rng.normal(size=(40, 4)) * 1e-6 - 900])
    edges, start = graph.build_graph(x, degree=6, beam=12)
    reached, front = {start}, [start]
    while front:
        front = [v for u in front for v in edges[u].tolist() if v < len(x) and v not in reached]
        front = list(set(front))
        reached.update(front)
    assert reached == set(range(len(x)))


def test_graph_recall_on_a_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], None) for r in df.collect()]
    got = graph.nearest(df, df.where("vec_id % 100 = 0"), graph.build_index(df, shard_rows=2000)).collect()
    assert check_answers(got, brute(rows, set(range(0, 10**6, 100)))) >= 0.95
