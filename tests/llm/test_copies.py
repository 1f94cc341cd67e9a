"""Exact copies, linked n-gram sets, repeated passages: against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import components, exact, ngram_join, substrings
from broadsheet.llm.base import texts
from helpers import WORD, frame, odd_texts, prose

SPACE = re.compile("[\x20\x09-\x0d]")


def family(seed: int, n: int, words: int, edits: int) -> list[str]:
    """A text and copies of it with a few words changed."""
    rng = random.Random(seed)
    base = prose(seed, words).split()
    out = [" ".join(base)]
    for k in range(n):
        own = list(base)
        for _ in range(edits):
            own[rng.randrange(len(own))] = f"w{seed}x{k}{rng.random():.6f}"
        out.append(" ".join(own))
    return out


def corpus() -> list[str | None]:
    shared = prose(50, 60)
    out = odd_texts() + family(11, 12, 150, 3) + family(12, 6, 60, 2) + family(13, 6, 400, 14)
    out += [prose(60 + k, 40) + " " + shared + " " + prose(80 + k, 30) for k in range(6)]
    random.Random(3).shuffle(out)
    return out


# ---------------------------------------------------------------- exact


def plain_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), i))
    out = {}
    for i, t in rows:
        norm = SPACE.sub("", t or "")
        own = groups[norm]
        out[i] = (min(own)[1], len(own), min(own)[1] == i, hashlib.sha256(norm.encode()).hexdigest())
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_exact(spark, weak):
    rows = list(enumerate(corpus(), start=-5))
    # A weak key chains different texts; a bucket of two keys doubles the directory often.
    key = (lambda c: F.length(c) % 3) if weak else F.xxhash64
    got = {r[0]: tuple(r[1:]) for r in exact.exact_groups(frame(spark, rows, clashing=True), capacity=2, key=key).collect()}
    assert got == plain_exact(rows)


def test_exact_directory_doubles(spark):
    keys = spark.range(1000).select(F.xxhash64("id").alias("key"))
    depth = exact.directory_depth(keys, 10)
    fullest = keys.groupBy(exact.bucket(F.col("key"), depth)).count().agg(F.max("count")).first()[0]
    assert fullest <= 10 and depth >= 7
    assert exact.directory_depth(spark.range(50).select(F.lit(7).cast("long").alias("key")), 10) == 0


def test_exact_without_ids_and_empty(spark):
    got = exact.exact_groups(frame(spark, [(None, "a b"), (4, "ab"), (None, "c")])).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == [("4", "4", 2, True), ("None", "4", 2, False), ("None", "None", 1, True)]
    assert exact.exact_groups(frame(spark, [])).count() == 0
    assert exact.drop_copies(frame(spark, [])).count() == 0


def test_drop_copies_keeps_columns(spark):
    docs = frame(spark, [(1, "a b"), (2, "a  b"), (3, "c"), (3, "c"), (5, None)], clashing=True)
    got = exact.drop_copies(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [2, 3, 5]


def test_drop_copies_decides_rows_that_share_an_id(spark):
    rows = [(None, "x"), (None, "y"), (None, "y"), (None, "z"), (7, "z"), (3, "a"), (3, "b"), (3, "b"), (3, "b "), (4, "a")]
    got = exact.drop_copies(frame(spark, rows, clashing=True)).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("3", "a"), ("3", "b "), ("7", "z"), ("None", "x"), ("None", "y")]
    got = exact.drop_copies(frame(spark, [(None, "a b"), (None, "a  b"), (1, "c")])).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("1", "c"), ("None", "a  b")]


# ---------------------------------------------------------------- n-gram join


def ngrams(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def plain_classes(rows, n, least):
    sets = {i: ngrams(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                same = len(sets[a] & sets[b])
                if 100 * same >= least * (len(sets[a]) + len(sets[b]) - same):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("n,least", [(4, 85), (5, 80), (1, 60)])
def test_ngram_classes(spark, n, least):
    rows = list(enumerate(corpus()))
    got = {r[0]: (r[1], r[2]) for r in ngram_join.classes(frame(spark, rows, clashing=True), n, least).collect()}
    assert got == plain_classes(rows, n, least)


def test_ngram_links_through_a_chain(spark):
    """Neighbours of a chain link, its ends do not; all are one component."""
    words = prose(9, 100).split()
    rows = [(100 - k, " ".join(words[: 100 - 3 * k] + [f"n{j}" for j in range(3 * k)])) for k in range(12)]
    got = {r[0]: (r[1], r[2]) for r in ngram_join.classes(frame(spark, rows), 4, 85).collect()}
    assert got == plain_classes(rows, 4, 85)
    assert len({c for _, c in got.values()}) == 1


def test_ngram_edges(spark):
    assert ngram_join.classes(frame(spark, [])).count() == 0
    got = sorted(map(tuple, ngram_join.classes(frame(spark, [(None, "a b c d e"), (1, "a b c d e"), (2, None), (3, " "), (4, "q"), (5, "Q")])).collect()), key=str)
    assert got == sorted([(None, 2, None), (1, 2, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4)], key=str)
    docs = frame(spark, [(1, "a b c d e"), (2, "A b c d e"), (3, None), (None, "a b c d e")], clashing=True)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]


def test_ngram_rows_that_share_an_id(spark):
    """Different texts under one id are different documents: a near copy is linked, another text is left alone."""
    passage, other = prose(40, 80), prose(41, 60)
    rows = [(1, passage), (5, passage + " word"), (5, other), (5, passage + " word"), (7, other + " end"), (None, passage)]
    got = sorted(map(tuple, ngram_join.classes(frame(spark, rows, clashing=True)).select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(1, 1), (5, 1), (5, 5), (5, 1), (7, 5), (None, None)], key=str)
    kept = sorted(((str(r.doc_id), r.text) for r in ngram_join.keep_one(frame(spark, rows, clashing=True)).collect()))
    assert kept == sorted([("1", passage), ("5", other), ("None", passage)])


def test_ngram_families_that_share_ngrams(spark):
    """Overlapping families around common passages, some just below the limit: the groups of brute force, and few pairs."""
    rng = random.Random(21)
    common = [prose(500 + k, 40) for k in range(5)]
    rows = []
    for k in range(60):
        base = (rng.choice(common) + " " + prose(600 + k, 60) + " " + rng.choice(common)).split()
        for _ in range(rng.choice((1, 2, 6))):
            own = list(base)
            for _ in range(rng.choice((0, 2, 4, 6))):
                own[rng.randrange(len(own))] = f"e{rng.random():.9f}"
            rows.append((len(rows), " ".join(own)))
    got = {r[0]: (r[1], r[2]) for r in ngram_join.classes(frame(spark, rows)).collect()}
    assert got == plain_classes(rows, 4, 85)


def test_bloom_filter_lets_its_ids_pass(spark):
    import numpy as np

    words = ngram_join.bloom(spark.range(0, 3000, 3), 16)
    got = ngram_join._among(np.arange(3000, dtype=np.int64).view(np.uint64), words)
    assert len(words) == 1 << 10 and got[::3].all() and got.mean() < 0.4


def test_components(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(0, 300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {x: find(x) for x in root}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- substrings


def plain_removed(rows, window):
    split = {i: WORD.findall(t or "") for i, t in rows}
    least = {}
    for i, words in split.items():
        for k in range(len(words) - window + 1):
            g = tuple(words[k : k + window])
            least[g] = min(i, least.get(g, i))
    out = {}
    for i, words in split.items():
        gone = set()
        for k in range(len(words) - window + 1):
            if least[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("window", [13, 5, 2, 1])
def test_removed(spark, window):
    rows = list(enumerate(corpus(), start=-20))
    got = {r[0]: tuple(r[1:]) for r in substrings.removed(frame(spark, rows, clashing=True), window).collect()}
    assert got == plain_removed(rows, window)


def test_removed_with_long_runs_and_periods(spark):
    rows = list(enumerate(["a " * 40, "b " + "a " * 30 + "c", "a b " * 25, "x a b a b a b a b a b a b a b a b y", "a b c " * 12, "c a b c a b c a b c a b c a b c"]))
    got = {r[0]: tuple(r[1:]) for r in substrings.removed(frame(spark, rows)).collect()}
    assert got == plain_removed(rows, 13)


def test_equal_windows_have_equal_anchors():
    import numpy as np

    rng = np.random.default_rng(1)
    passage = rng.integers(1, 30, 40).astype(np.uint64)
    seen = {}
    for trial in range(30):
        left, right = (rng.integers(1, 30, rng.integers(0, 20)).astype(np.uint64) for _ in "ab")
        words = np.concatenate([left, passage, right])
        start, first, last = substrings.anchors(words, np.array([0, len(words)]))
        for s, a, b in zip(start.tolist(), first.tolist(), last.tolist()):
            assert s <= a < b <= s + 13 and b - a >= 7
            assert seen.setdefault(tuple(words[s : s + 13].tolist()), (a - s, b - s)) == (a - s, b - s)


def test_cut_repeats(spark):
    long = prose(4, 60)
    docs = frame(spark, [(1, long), (2, "start here " + long + " end"), (3, None), (None, long), (5, long), (6, "kept\n as it  is")], clashing=True)
    got = substrings.cut_repeats(docs)
    assert got.columns == docs.columns
    rows = {r.doc_id: (r.text, r.n_chars) for r in got.collect()}
    assert rows == {1: (long, len(long)), 2: ("start here end", 14), 3: (None, None), None: (long, len(long)), 5: ("", 0), 6: ("kept\n as it  is", 15)}
    assert substrings.cut_repeats(frame(spark, [])).count() == 0
    assert substrings.removed(texts(frame(spark, []))).count() == 0


def test_segments_carry_one_place(spark):
    """A shuffled segment is an anchor, a document and one number that holds its first window and its windows."""
    words = [f"w{k % 37}" for k in range(400)]
    rows = [(1, " ".join(words).encode()), (2, " ".join(words[5:60]).encode()), (3, b"too short")]
    out = substrings.segments(spark.createDataFrame(rows, "doc_id long, text binary"))
    assert out.columns == ["anchor", "doc_id", "place"]
    for doc, n_words in ((1, 400), (2, 55)):
        at = sorted((r.place >> substrings.PLACE_BITS, r.place % (1 << substrings.PLACE_BITS)) for r in out.where(f"doc_id = {doc}").collect())
        assert at[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(at, at[1:])) and sum(at[-1]) == n_words - substrings.WINDOW + 1
