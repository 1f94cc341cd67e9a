"""Keyword coverage against plain containment tests."""

import random

from pyspark.sql import functions as F

from broadsheet.operators import coverage
from broadsheet.plans import audits


def covered(tokens, classes, docs):
    return [i for i, text, own in docs if tokens and all(t in (text or "") for t in tokens) and set(classes) <= set(own)]


def test_coverage_equals_containment(spark):
    rng = random.Random(2)
    parts = ["an", "ter", "mia", "ge", "lo", "xq", "数据", "é", "a.b"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    docs = [(k * 7 - 300, None if k % 40 == 0 else " ".join([word() for _ in range(rng.randint(0, 9))] + ["tail,end·x/y", "z" * 300][: k % 3]), ["c1"] if k % 2 else ["c1", "c2"]) for k in range(300)]
    docs += [(10_000 + k, "common anter", ["c2"]) for k in range(400)]  # a term that very many documents hold
    keywords = [(f"k{n}", list(dict.fromkeys(word()[: rng.randint(2, 5)] for _ in range(rng.randint(1, 4)))), rng.choice([[], ["c1"], ["c2"], ["c1", "c2"], ["none"]])) for n in range(120)]
    keywords = [(k, [t for t in ts if len(t) >= 2], cs) for k, ts, cs in keywords] + [("common", ["common", "nte"], []), ("long", ["z" * 200], []), ("none", ["qqq"], []), ("empty", [], [])]
    d = spark.createDataFrame(docs, "ord long, text string, classes array<string>").repartition(4)
    rows = [(k, ts + [coverage.CLASS + c for c in cs] if ts else []) for k, ts, cs in keywords]
    kw = spark.createDataFrame(rows, "keyword string, needed array<string>")
    found = coverage.covering(kw, "keyword", "needed", d, "ord", "text", "classes")
    want = {k: covered(ts, cs, docs) for k, ts, cs in keywords}
    assert {r["keyword"]: r["n_docs"] for r in coverage.counted(found, "keyword").collect()} == {k: len(w) for k, w in want.items() if w}
    first = sorted((r["keyword"], r["rank"], r["ord"]) for r in coverage.first_documents(found, "keyword", "ord", 5).collect())
    assert first == sorted((k, n + 1, i) for k, w in want.items() for n, i in enumerate(sorted(w)[:5]))
    # A term of 400 neighbouring documents takes a row per 64 of them, not per document.
    assert found.where("keyword = 'common'").count() <= 8


def test_keyword_analysis_and_kit(spark):
    rows = spark.createDataFrame([("heart care price", 50), ("heart care price", 700), ("cat heart", 900), ("dog", 900), ("", 5), ("heart", 90)], "keyword string, volume long")
    kw = audits.analysed_keywords(rows, "cat|dog|heart", (("a", "heart"), ("b", "care|cat"), ("c", "care|price")), ("price",))
    got = {r["keyword"]: (r["volume"], r["topic"], r["tokens"]) for r in kw.collect()}
    assert got == {"heart care price": (700, "c", ["heart", "care"]), "cat heart": (900, "a", ["cat", "heart"]), "dog": (900, None, ["dog"]), "heart": (90, "a", ["heart"])}
    docs = spark.createDataFrame(
        [(1, "Cats", "heart careful", "cat", True), (2, "Dogs", "hearty care of cats", "dog", True), (3, "", "heart care", "cat", True), (4, "Cats of", None, "cat", False)],
        "ord long, title string, lead string, kind string, angle boolean",
    )
    gaps = {r["keyword"]: (r["articles"], r["verdict"]) for r in audits.keyword_gaps(kw, docs, "ord", "title", "lead").collect()}
    assert gaps == {"heart care price": (2, "strong"), "cat heart": (1, "strong"), "dog": (0, "gap"), "heart": (2, "small")}
    rules = [("cat", "cat", None), ("dog", "dog", "cat")]
    hay = docs.where("title <> ''").select("ord", F.concat_ws(" ", F.lower("title"), "lead").alias("hay"), F.array("kind").alias("classes"))
    kit = audits.content_kit(kw, hay, "ord", "hay", "classes", "heart|care|cat|dog", coverage.class_terms(F.col("keyword"), rules))
    assert sorted((r["keyword"], r["ord"], r["rank"]) for r in kit.collect()) == [("cat heart", 1, 1), ("heart care price", 1, 1), ("heart care price", 2, 2)]
