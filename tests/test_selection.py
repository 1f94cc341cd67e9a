"""Jobs whose order or counting matters: collected candidates, repeated images, decisions given twice."""

from pyspark.sql import functions as F

from broadsheet.plans import selection


def test_social_duplicates_follow_the_order_of_collection(spark):
    schema = "id string, title string, keys array<string>, ord long"
    empty = spark.createDataFrame([], schema)
    news = empty.select("*", F.lit("f").alias("feed"), F.lit(0).cast("long").alias("feed_ord"))
    social = spark.createDataFrame([("a", "one", ["u"], 1, 5.0), ("b", "two", ["u"], 2, 9.0), ("c", "three", ["v"], 3, 7.0)], schema + ", score double")
    seen = spark.createDataFrame([], "key string")
    got = selection.collect_candidates(empty, news, social, seen, F.col("ord") * 0)
    assert {r.id for r in got.collect()} == {"a", "c"}
    first = selection.collect_candidates(empty, news, social, seen, F.col("ord") * 0, limit=1)
    assert [r.id for r in first.collect()] == ["c"]  # the list itself is by score


def test_ingest_ranks_by_the_exact_score(spark):
    rows = spark.createDataFrame([(1, 1, "cat", "x", ["a"], "s"), (2, 2, "cat", "x", ["b"], "s")], "id long, ord long, title string, description string, url_keys array<string>, source_id string")
    at = F.when(F.col("id") == 1, F.lit("2024-01-01 00:00:00")).otherwise(F.lit("2024-01-01 00:01:30")).cast("timestamp")
    entries = rows.select("*", at.alias("published_at"), F.lit(False).alias("has_canonical"), F.lit(50).alias("priority"))
    status = entries.select("id", F.lit("unique").alias("status"))
    seen = spark.createDataFrame([], "key string")
    got = selection.ingest(entries, status, seen, F.lit("2024-01-05").cast("timestamp"), 1, 5, 1, "cat").collect()
    assert [r.id for r in got] == [2]  # 90 seconds newer, equal after rounding


def test_update_classes(spark):
    schema = "id string, ord long, title string, url string, more_urls array<string>, title_text string, paragraphs array<string>, verified boolean"
    prior = [("p1", 1, "feline study of hearts", "u1", ["r1", None], "a", ["10 mg given", "2 cats"], None), ("p2", 2, "canine diet trial results", "", ["r2", "c2"], "b", ["5 %"], None)]
    cand = [
        ("duplicate", 0, "feline study of hearts", "u1", [], "a", ["10 mg", "given 2 cats"], True),
        ("other-url", 0, "feline study of hearts", "x", [None], "a", ["99 mg"], True),
        ("minor", 0, "renamed altogether", "u1", None, "a", ["10 mg given", "2 cats"], True),
        ("substantive", 0, "renamed altogether", "u1", [""], "a", ["20 mg", "2"], True),
        ("correction", 0, "feline study of hearts", "y", ["c9", "r1"], "a", ["an erratum: 20 mg"], True),
        ("raw", 0, "canine diet trial results", "", ["c2"], "b", ["5 %"], True),
        ("near", 0, "canine diet trial results again", "z", [], "b", ["5 %"], True),
        ("new", 0, "entirely different words", None, [], "c", None, True),
        ("unverified", 0, "", None, [], None, [], False),
    ]
    frame = lambda rows: spark.createDataFrame(rows, schema).withColumns({"body": selection.update_text("title_text", "paragraphs"), "more_urls": F.coalesce("more_urls", F.array().cast("array<string>"))})
    got = {r.id: (r.match_id, r["class"]) for r in selection.detect_updates(frame(cand), frame(prior)).collect()}
    assert got == {
        "duplicate": ("p1", "duplicate"), "other-url": ("p1", "duplicate"), "minor": ("p1", "minor-update"), "substantive": ("p1", "substantive-update"), "correction": ("p1", "correction"),
        "raw": ("p2", "duplicate"), "near": ("p2", "unresolved"), "new": (None, "separate-story"), "unverified": (None, "unresolved"),
    }


def test_all_update_classes_occur(spark):
    from broadsheet import catalog

    catalog.load_all()
    got = {r["class"] for r in catalog.QUERIES["jb14_update_counts"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {"duplicate", "minor-update", "substantive-update", "correction", "separate-story", "unresolved"}
