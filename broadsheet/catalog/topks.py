"""Queries for sorts, limits and top-k (TK*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.dates import age_days
from ..operators import topk as K
from ..operators.segments import row_number
from . import query
from .rules import DEMO_TOPICS, with_topics
from .tables import DATED, ITEMS, NOW, dated, items, now, table, with_sql


@query("tk1_above_threshold", "SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE coalesce(quality, 0) >= 1 ORDER BY quality DESC, d.doc_id LIMIT 100")
def _(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return K.above_threshold(d, "quality", 1, [F.col("doc_id")], 100).select("doc_id", "quality")


@query("tk2_tier_split", """
    WITH s AS (SELECT o_orderkey, CAST(floor(o_totalprice / 50000) AS BIGINT) AS score FROM orders), d AS (SELECT *, 'deep' AS tier FROM s WHERE score >= 5 ORDER BY score DESC, o_orderkey LIMIT 42),
    b AS (SELECT *, 'brief' AS tier FROM s WHERE score >= 3 AND score < 5 AND o_orderkey NOT IN (SELECT o_orderkey FROM d) ORDER BY score DESC, o_orderkey LIMIT 90) SELECT * FROM d UNION ALL SELECT * FROM b""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 50000).alias("score"))
    return K.tier_split(o, "o_orderkey", "score", [F.col("o_orderkey")], 42, 90)


# A billionth lifts values that stand exactly between two digits, which the two systems round differently.
SQL_SCORE = f"""round(1e-9 + 0.40 * (CASE WHEN d.event_type = 'error' THEN 0.15 ELSE greatest(0.0, 1 - abs((epoch_us(TIMESTAMP '{NOW}') - epoch_us(d.ts)) / 86400000000.0) / 30) END) + 0.25 * least(1.0, length(d.text) / 600)
    + 0.20 * least(1.0, len(list_distinct([lower(t) for t in regexp_extract_all(d.title || ' ' || d.text, 'veterin|animal health|animal hospital|pet health|dog|cat|canine|feline|equine|veterinary|zoon|rabies|parasit|antimicrobial|clinical|journal|medicine|병원|동물|수의|반려|질환|감염|백신|논문|임상', 0, 'i')])) / 4)
    + 0.10 * (CASE WHEN d.lang = 'en' THEN 1.0 ELSE 0.0 END) + 0.05 * least(1.0, (CASE WHEN d.user_id = 0 THEN 50 ELSE d.user_id END) / 100), 4)"""


def scored(spark, sf):
    d = dated(spark, sf)
    age = F.when(F.col("event_type") != "error", age_days(F.col("ts"), now()))
    return d.withColumn("score", F.round(K.selection_score(age, F.col("text"), F.col("title"), F.col("lang") == "en", F.col("user_id")) + 1e-9, 4))


@query("tk3_selection_score", with_sql(DATED, f"SELECT doc_id, {SQL_SCORE} AS score FROM dated d"))
def _(spark, sf):
    return scored(spark, sf).select("doc_id", "score")


def linked(spark, sf):
    """Articles with topics, an entity and a category."""
    a = with_topics(dated(spark, sf))
    return a.select("doc_id", F.col("doc_id").cast("string").alias("id"), "topics", F.array(F.concat(F.lit("e"), (F.col("n_chars") % 40).cast("string"))).alias("entities"), F.col("lang").alias("category"), (F.col("n_chars") > 200).alias("eligible"), "ts")


SQL_TOPICS = DATED + ", h AS (SELECT doc_id, unnest([" + ", ".join(
    f"{{'ord': {i}, 'slug': '{s}', 'm': len(regexp_extract_all(title, '{m}', 0, 'i')), 'b': len(regexp_extract_all(text, '{m}', 0, 'i'))}}" for i, (s, m) in enumerate(DEMO_TOPICS)
) + """]) AS x FROM art), tf AS (SELECT doc_id, x.ord AS ord, x.slug AS slug, x.m AS m, x.b AS b, max(x.m) OVER (PARTITION BY doc_id) AS top FROM h),
tr AS (SELECT doc_id, slug, row_number() OVER (PARTITION BY doc_id ORDER BY m DESC, b DESC, ord) AS rn, top FROM tf WHERE (top > 0 AND m > 0) OR (top = 0 AND b >= 2)),
tl AS (SELECT doc_id, list(slug ORDER BY rn) AS topics FROM tr WHERE rn <= CASE WHEN top > 0 THEN 3 ELSE 1 END GROUP BY doc_id)"""


@query("tk4_related", with_sql(SQL_TOPICS, """
    , a AS (SELECT d.doc_id, d.ts, d.lang, d.n_chars % 40 AS entity, d.n_chars > 200 AS eligible, coalesce(t.topics, []) AS topics FROM dated d LEFT JOIN tl t ON t.doc_id = d.doc_id),
    s AS (SELECT a.doc_id, b.doc_id AS related, 10 * len(list_intersect(a.topics, b.topics)) + CASE WHEN a.entity = b.entity THEN 18 ELSE 0 END + CASE WHEN a.lang = b.lang THEN 3 ELSE 0 END AS score, b.ts FROM a JOIN a b ON a.doc_id <> b.doc_id AND b.eligible),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ts DESC, related::VARCHAR) AS rank FROM s)
    SELECT doc_id::VARCHAR AS id, CAST(rank AS INTEGER) AS rank, related::VARCHAR AS related, score FROM r WHERE rank <= 5"""))
def _(spark, sf):
    return K.related(linked(spark, sf), "id", "topics", "entities", "category", "eligible", "ts")


@query("tk5_weekly_top", """
    WITH r AS (SELECT o_orderkey, strftime(o_orderdate, '%G-W%V') AS week, row_number() OVER (PARTITION BY strftime(o_orderdate, '%G-W%V') ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders WHERE o_orderpriority <> '5-LOW')
    SELECT week, CAST(rank AS INTEGER) AS rank, o_orderkey FROM r WHERE rank <= 12 AND week IN (SELECT week FROM r GROUP BY week HAVING count(*) >= 3)""")
def _(spark, sf):
    o = table(spark, sf, "orders").where("o_orderpriority <> '5-LOW'")
    return K.weekly_top(o, "o_orderdate", [F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("week", "rank", "o_orderkey")


@query("tk6_recent_items", with_sql(ITEMS, """
    , m AS (SELECT max(date) AS d FROM items), o AS (SELECT i.*, row_number() OVER (PARTITION BY source_url ORDER BY date DESC, doc_id) AS rn FROM items i, m WHERE date <> d),
    p AS (SELECT DISTINCT category FROM items, m WHERE date = d AND doc_id % 7 = 0) SELECT doc_id, CASE WHEN category IN (SELECT category FROM p) THEN 1 ELSE 0 END AS preferred FROM o WHERE rn = 1 ORDER BY 2 DESC, date DESC, doc_id LIMIT 6"""))
def _(spark, sf):
    i = items(spark, sf)
    newest = i.agg(F.max("date")).scalar()
    preferred = i.where((F.col("date") == newest) & (F.col("doc_id") % 7 == 0)).select("category")
    return K.recent_items(i, "source_url", newest, "date", "category", preferred, [F.col("date").desc(), F.col("doc_id")]).select("doc_id", "preferred")


@query("tk7_release_order", "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'F' DESC, o_orderpriority = '1-URGENT' DESC, o_totalprice DESC, o_orderkey) AS INTEGER) AS place FROM orders")
def _(spark, sf):
    order = K.release_order(F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"), [F.col("o_orderkey")])
    return table(spark, sf, "orders").withColumn("place", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*order))).select("o_orderkey", "place")


@query("tk8_distinct_newest", with_sql(ITEMS, """
    , r AS (SELECT doc_id, published_at, row_number() OVER (PARTITION BY source_url ORDER BY published_at DESC, doc_id) AS rn FROM items) SELECT doc_id FROM r WHERE rn = 1 ORDER BY published_at DESC, doc_id LIMIT 100"""))
def _(spark, sf):
    return K.distinct_newest(items(spark, sf), "source_url", [F.col("published_at").desc(), F.col("doc_id")], 100).select("doc_id")


@query("tk9_review_priority", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 40 WHEN 'O' THEN 25 ELSE 10 END + CASE WHEN o_orderpriority = '1-URGENT' THEN 40 WHEN o_orderpriority = '2-HIGH' THEN 20 ELSE 0 END + CASE WHEN o_totalprice > 300000 THEN 15 ELSE 0 END AS priority FROM orders""")
def _(spark, sf):
    risk = F.when(F.col("o_orderstatus") == "F", "high").when(F.col("o_orderstatus") == "O", "medium").otherwise("low")
    status = F.when(F.col("o_orderpriority") == "1-URGENT", "correction-required").when(F.col("o_orderpriority") == "2-HIGH", "vet-review-required").otherwise("draft")
    return table(spark, sf, "orders").select("o_orderkey", K.review_priority(risk, status, F.col("o_totalprice") > 300000, F.lit(False)).alias("priority"))


SQL_PERF_ROWS = "perf AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity AS impressions, l_discount AS ctr, CAST(l_linenumber AS DOUBLE) + 2 AS position FROM lineitem)"


def perf_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_quantity").alias("impressions"), F.col("l_discount").alias("ctr"), (F.col("l_linenumber") + 2).cast("double").alias("position"))


TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("tk10_low_ctr", with_sql(SQL_PERF_ROWS, "SELECT l_orderkey, l_linenumber, impressions, ctr FROM perf WHERE impressions >= 20 AND ctr < 0.02 ORDER BY impressions DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 100"))
def _(spark, sf):
    return K.low_ctr(perf_rows(spark, sf), [F.col(c) for c in TIE]).select("l_orderkey", "l_linenumber", "impressions", "ctr")


@query("tk10_near_top", with_sql(SQL_PERF_ROWS, "SELECT l_orderkey, l_linenumber, impressions, position FROM perf WHERE position BETWEEN 5 AND 20 ORDER BY impressions DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 100"))
def _(spark, sf):
    return K.near_top(perf_rows(spark, sf), [F.col(c) for c in TIE]).select("l_orderkey", "l_linenumber", "impressions", "position")


@query("tk11_edition_plan", """
    WITH s AS (SELECT o_orderkey, o_orderpriority AS tier, CASE o_orderstatus WHEN 'F' THEN 40 WHEN 'O' THEN 25 ELSE 10 END + CASE o_orderpriority WHEN '1-URGENT' THEN 15 WHEN '2-HIGH' THEN 10 ELSE 0 END + CASE WHEN o_totalprice > 250000 THEN 10 ELSE 0 END + 5 AS score FROM orders),
    t AS (SELECT * FROM s ORDER BY score DESC, o_orderkey LIMIT 8) SELECT CASE tier WHEN '1-URGENT' THEN 'evidence' WHEN '2-HIGH' THEN 'analysis' ELSE 'brief' END AS tier, count(*) AS n, CAST(max(score) AS INTEGER) AS best FROM t GROUP BY 1""")
def _(spark, sf):
    tier = F.when(F.col("o_orderpriority") == "1-URGENT", "evidence").when(F.col("o_orderpriority") == "2-HIGH", "analysis").otherwise("brief")
    risk = F.when(F.col("o_orderstatus") == "F", "high").when(F.col("o_orderstatus") == "O", "medium").otherwise("low")
    s = table(spark, sf, "orders").withColumn("tier", tier)
    s = s.withColumn("score", K.schedule_score(risk, F.col("tier"), F.when(F.col("o_totalprice") > 250000, "verified"), F.lit(None)))
    return s.orderBy(F.col("score").desc(), "o_orderkey").limit(8).groupBy("tier").agg(F.count("*").alias("n"), F.max("score").alias("best"))


@query("tk12_packet", with_sql(ITEMS, """
    , q AS (SELECT id, 'correction' AS type, 120 AS score, 0 AS o FROM items WHERE workflow_status = 'correction-required' UNION ALL SELECT id, 'high-risk', 110, 1 FROM items WHERE clinical_risk = 'high'
      UNION ALL SELECT id, 'low-risk-draft', 100, 2 FROM items WHERE clinical_risk = 'low' AND source_status = 'verified' UNION ALL SELECT id, 'medium-risk', 90, 3 FROM items WHERE clinical_risk = 'medium'),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, o) AS rn FROM q) SELECT id, type, score FROM r WHERE rn = 1 ORDER BY score DESC, id LIMIT 10"""))
def _(spark, sf):
    i = items(spark, sf)

    def queue(cond, kind, score, ord_):
        return i.where(cond).select("id", F.lit(kind).alias("type"), F.lit(score).alias("score"), F.lit(ord_).alias("queue_ord"))

    return K.packet([
        queue("workflow_status = 'correction-required'", "correction", 120, 0), queue("clinical_risk = 'high'", "high-risk", 110, 1),
        queue("clinical_risk = 'low' AND source_status = 'verified'", "low-risk-draft", 100, 2), queue("clinical_risk = 'medium'", "medium-risk", 90, 3),
    ]).select("id", "type", "score")


@query("tk13_topic_lists", with_sql(SQL_TOPICS, """
    , n AS (SELECT t.slug, t.doc_id, row_number() OVER (PARTITION BY t.slug ORDER BY d.ts DESC, t.doc_id) AS place FROM (SELECT doc_id, unnest(topics) AS slug FROM tl) t JOIN dated d ON d.doc_id = t.doc_id)
    SELECT slug, CAST(place AS INTEGER) AS place, doc_id FROM n"""))
def _(spark, sf):
    t = linked(spark, sf).select("doc_id", "ts", F.explode("topics").alias("slug"))
    # A topic may hold a large share of all articles, so it is ranked day by day; articles without a time come last.
    day = F.coalesce(-F.unix_date(F.to_date("ts")), F.lit(1 << 30))
    return row_number(t, ["slug"], day, [F.col("ts").desc(), F.col("doc_id")], "place").select("slug", F.col("place").cast("int").alias("place"), "doc_id")


