"""Indexed search against the scan, and counts united from stored sketches."""

import random
import time

from pyspark.sql import functions as F

from broadsheet.operators import aggregate, coverage, filters, search


def entries(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 7)))
    rows = [(k * 3 - 200, None if k % 50 == 0 else f"2024-{1 + k // 60:02d}", "x" if k % 3 else "y", word() + "Needle In" * (k % 97 == 5), None if k % 40 == 0 else " ".join(word() for _ in range(12))) for k in range(500)]
    return spark.createDataFrame(rows, "ord long, month string, category string, title string, text string").repartition(4)


def test_indexed_search_equals_the_scan(spark, tmp_path):
    df = entries(spark)
    search.write_index(df, "ord", "month", ["title", "text"], f"{tmp_path}/index")
    read = df.where("ord % 2 = 0").select("ord")
    for query in ("needle in", " Needle", "ab", "abc", "dea b", "é", "éa", "nothing of it", "", "a b c d e f g"):
        for category, ids in ((None, None), ("x", None), ("all", read), ("y", read)):
            want = sorted(r.ord for r in filters.search(df, query, [F.col("title"), F.col("text")], category, ids, "ord").collect())
            got = search.search_index(spark, f"{tmp_path}/index", query, category, ids, "ord")
            assert sorted(r.ord for r in got.collect()) == want
            assert got.columns[:4] == ["ord", "category", "title", "text"]


def test_indexed_search_reads_less(spark, tmp_path):
    df = entries(spark).withColumn("title", F.when(F.col("ord") == 403, "a unique hippopotamus").otherwise(F.col("title")))
    search.write_index(df, "ord", "month", ["title", "text"], f"{tmp_path}/index")
    found = search.candidates(spark, f"{tmp_path}/index", "hippopot").collect()
    assert len(found) == 1  # one block of one month
    hits = search.search_index(spark, f"{tmp_path}/index", "hippopot").collect()
    assert [r.ord for r in hits] == [403]
    plan = search.search_index(spark, f"{tmp_path}/index", "hippopot")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and found[0]["month"] in plan
    assert search.candidates(spark, f"{tmp_path}/index", "hi") is None


def test_sketches_unite(spark, tmp_path):
    rng = random.Random(7)
    rows = [(f"2024-01-{1 + k % 9:02d}", "a" if k % 5 else None, rng.randrange(4000), f"v{rng.randrange(30)}") for k in range(20_000)]
    df = spark.createDataFrame(rows, "day string, kind string, many long, few string")
    aggregate.period_sketches(df, F.col("day"), ["kind"], ["many", "few"]).write.parquet(f"{tmp_path}/s")
    stored = spark.read.parquet(f"{tmp_path}/s")
    assert stored.count() == 18
    whole = {r.kind: r for r in aggregate.united_counts(aggregate.period_sketches(df, F.lit(1), ["kind"], ["many", "few"]), ["kind"], ["many", "few"]).collect()}
    for r in aggregate.united_counts(stored, ["kind"], ["many", "few"]).collect():
        exact = len({m for _, k, m, _ in rows if k == r.kind})
        assert r.few == 30 and abs(r.many - exact) <= 0.05 * exact and abs(r.many - whole[r.kind].many) <= 0.05 * exact
    days = aggregate.united_counts(stored.where("period < '2024-01-04'"), [], ["many"]).first()
    exact = len({m for d, _, m, _ in rows if d < "2024-01-04"})
    assert abs(days.many - exact) <= 0.05 * exact


def test_grams_of_long_texts_take_linear_time(spark):
    rng = random.Random(8)
    long = "".join(rng.choice("ab é\n😀수") for _ in range(600_000))
    started = time.monotonic()
    rows = spark.createDataFrame([(long,), ("a😀b",), ("ab",), ("",), (None,)], "t string").select("t", coverage.grams(F.col("t"), 3).alias("g")).collect()
    assert time.monotonic() - started < 40  # minutes when every gram is looked up from the start of the text
    for r in rows:
        assert sorted(r.g) == sorted({(r.t or "")[i : i + 3] for i in range(len(r.t or "") - 2)})
