"""Ranked lexical search against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm import lexical
from helpers import frame, odd_texts, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, places):
    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        ranked = []
        for i, c in counted:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(words(text)) if t in c)
            if score > 0:
                ranked.append((-score, i is None, i or 0, i))
        ranked.sort(key=lambda r: r[:3])
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(ranked[:places])]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_resolve_equals_all_sums(seed):
    rng = np.random.default_rng(seed)
    docs, gains = 400, (5, 1000)[seed % 2]  # small gains: many ties
    lists, total = [], np.zeros(docs, dtype=np.int64)
    for _ in range(12):
        doc = rng.permutation(docs)[: rng.integers(1, docs)]
        gain = -np.sort(-rng.integers(1, gains, len(doc)) * rng.integers(1, 50))
        lists.append((doc, gain))
        total[doc] += gain
    for places, floor in ((1, 0), (10, 0), (10, int(np.sort(total)[-15])), (500, 0)):
        found, score = lexical.resolve(lists, docs, places, floor)
        assert (score == total[found]).all()
        least = max(floor, int(np.sort(total)[-places])) if places <= docs else max(floor, 1)
        assert set(np.flatnonzero(total >= max(least, 1))) <= set(found.tolist())


@pytest.mark.parametrize("places,block_chars,shard_size", [(50, 1 << 20, 1 << 20), (3, 60, 40)])
def test_search_equals_plain_python(spark, places, block_chars, shard_size):
    rng = random.Random(4)
    texts = odd_texts() + [prose(1, rng.randint(1, 200)) for _ in range(60)] + [prose(1, 9)] * 70
    docs = list(enumerate(texts, start=-9)) + [(None, texts[7]), (None, None), (3, texts[-1]), (3, prose(2, 50))]
    items = [(k, prose(1, 400).split(". ")[k] + " ONE ٣ naïve") for k in range(8)] + [(9, None), (10, "--- \x00"), (4, "two words two"), (None, "one"), (11, prose(1, 9)), (11, prose(1, 9))]
    got = lexical.search(frame(spark, docs, clashing=True).repartition(5), spark.createDataFrame(items, ITEMS).withColumn("item", F.lit("x")), places, block_chars=block_chars, shard_size=shard_size)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_search(docs, items, places)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], ITEMS)
    assert lexical.search(frame(spark, ["a b", "b"]), none).count() == 0
    assert lexical.search(frame(spark, []), spark.createDataFrame([(1, "a")], ITEMS)).count() == 0
    assert lexical.search(frame(spark, [None, " . "]), spark.createDataFrame([(1, "a")], ITEMS)).count() == 0
    assert lexical.search(frame(spark, ["a a"]), spark.createDataFrame([(1, "b"), (2, None)], ITEMS)).count() == 0
