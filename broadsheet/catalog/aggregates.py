"""Queries for aggregations (AG*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import filters as FL
from ..operators import rules as R
from ..session import shared_folder
from . import query
from .rules import SQL_DIAGNOSTIC, events_diagnostic
from .tables import ITEMS, items, table, with_sql


def flagged(spark, sf):
    i = items(spark, sf)
    flags = F.array_compact(F.array(F.when(F.col("quality") == 0, "low-quality"), F.when(F.col("toxic") == 1, "toxic"), F.when(F.col("n_chars") < 300, "short")))
    return i.select("lang", "source_label", "content_tier", "image_url", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("public"), (F.coalesce("visibility", F.lit("")) == "suppressed").alias("suppressed"), flags.alias("flags"))


@query("ag1_quality_report", with_sql(ITEMS, """
    , q AS (SELECT *, coalesce(quality = 1, FALSE) AS pub, coalesce(visibility, '') = 'suppressed' AS sup, list_filter([CASE WHEN quality = 0 THEN 'low-quality' END, CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN n_chars < 300 THEN 'short' END], lambda x: x IS NOT NULL) AS flags FROM items),
    l AS (SELECT 'total' AS dimension, 'all' AS value, pub, sup, image_url FROM q UNION ALL SELECT 'lang', lang, pub, sup, image_url FROM q UNION ALL SELECT 'source_label', source_label, pub, sup, image_url FROM q
      UNION ALL SELECT 'content_tier', coalesce(content_tier, 'all'), pub, sup, image_url FROM q UNION ALL SELECT 'flag', unnest(flags), pub, sup, image_url FROM q)
    SELECT dimension, value, count(*) AS raw, count(*) FILTER (pub) AS public, count(*) FILTER (sup) AS suppressed, count(image_url) AS with_image FROM l GROUP BY ALL"""))
def _(spark, sf):
    return A.quality_report(flagged(spark, sf), ["lang", "source_label", "content_tier"], "flags")


@query("ag2_count_by", "SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'unclassified' ELSE c_mktsegment END AS value, count(*) AS n FROM customer GROUP BY 1")
def _(spark, sf):
    return A.count_by(table(spark, sf, "customer"), F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")))


@query("ag3_operations_kpi", """
    SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS indexed, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 4) AS index_rate, count(DISTINCT o_custkey) AS sources,
      count(*) FILTER (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS high_waiting, bool_and(o_totalprice > 0) AS all_priced FROM orders""")
def _(spark, sf):
    indexed = F.col("o_orderstatus") == "F"
    return table(spark, sf, "orders").agg(
        F.count("*").alias("total"), F.count_if(indexed).alias("indexed"), F.round(F.count_if(indexed) / F.greatest(F.lit(1), F.count("*")), 4).alias("index_rate"),
        F.countDistinct("o_custkey").alias("sources"), F.count_if((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")).alias("high_waiting"),
        F.bool_and(F.col("o_totalprice") > 0).alias("all_priced"),
    )


def performance(spark, sf):
    """lineitem as search performance: quantity = impressions, line number = clicks."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("category"), F.col("l_linestatus").alias("provider"),
        F.year("l_shipdate").cast("string").alias("tier"), F.col("l_quantity").cast("long").alias("impressions"), F.col("l_linenumber").cast("long").alias("clicks"),
    )


SQL_PERF = "perf AS (SELECT l_returnflag AS category, l_linestatus AS provider, CAST(year(l_shipdate) AS VARCHAR) AS tier, CAST(l_quantity AS BIGINT) AS impressions, CAST(l_linenumber AS BIGINT) AS clicks FROM lineitem)"


@query("ag4_performance_groups", with_sql(SQL_PERF, """
    , u AS (SELECT 'category' AS dimension, category AS value, impressions, clicks FROM perf UNION ALL SELECT 'provider', provider, impressions, clicks FROM perf UNION ALL SELECT 'tier', tier, impressions, clicks FROM perf)
    SELECT dimension, value, CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks, count(*) AS n_rows, CAST(sum(clicks) AS DOUBLE) / greatest(1, CAST(sum(impressions) AS DOUBLE)) AS ctr FROM u GROUP BY 1, 2"""))
def _(spark, sf):
    return A.performance_groups(performance(spark, sf), ["category", "provider", "tier"])


@query("ag5_keyword_max", "SELECT p_name, arg_max(p_partkey, p_size * 1000000 - p_partkey) AS p_partkey, max(p_size) AS volume FROM part GROUP BY p_name")
def _(spark, sf):
    return A.keyword_max(table(spark, sf, "part"), "p_name", "p_size", "p_partkey").select("p_name", "p_partkey", F.col("p_size").alias("volume"))


@query("ag6_market_health", """
    SELECT r_name AS feed_group, n_name AS market, CASE WHEN grouping(r_name) = 1 THEN 3 WHEN grouping(n_name) = 1 THEN 1 ELSE 0 END AS level, count(*) AS total, count(*) FILTER (s_acctbal > 0) AS ok, CAST(sum(s_suppkey) AS BIGINT) AS items,
      count(*) FILTER (NOT s_acctbal > 0) AS failed, count(*) FILTER (s_acctbal < 1000) AS stale FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def _(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    feeds = s.select(F.col("r_name").alias("feed_group"), F.col("n_name").alias("market"), (F.col("s_acctbal") > 0).alias("ok"), F.col("s_suppkey").alias("items"), (F.col("s_acctbal") < 1000).alias("stale"))
    return A.market_health(feeds).withColumn("level", F.col("level").cast("int"))


@query("ag7_source_directory", with_sql(ITEMS, """
    , r AS (SELECT *, row_number() OVER (PARTITION BY source_label ORDER BY published_at DESC, doc_id) AS rn FROM items)
    SELECT source_label AS source, count(*) AS n_items, count(DISTINCT lang) AS n_countries, string_agg(CASE WHEN rn <= 3 THEN title END, '|' ORDER BY rn) AS newest FROM r GROUP BY 1"""))
def _(spark, sf):
    d = A.source_directory(items(spark, sf), "source_label", [F.col("published_at").desc(), F.col("doc_id")], "title", "lang")
    return d.withColumn("newest", F.array_join("newest", "|"))


@query("ag8_queue_counts", """
    WITH t AS (SELECT o_orderstatus AS type, CAST(o_totalprice / 3000 AS INTEGER) AS priority FROM orders)
    SELECT type, count(*) FILTER (priority >= 130) AS critical, count(*) FILTER (priority >= 90 AND priority < 130) AS high, count(*) FILTER (priority < 90) AS normal FROM t GROUP BY type""")
def _(spark, sf):
    t = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("type"), F.round(F.col("o_totalprice") / 3000).cast("int").alias("priority"))
    return A.queue_counts(t, FL.priority_bucket(F.col("priority")))


@query("ag9_selection_statistics", """
    WITH s AS (SELECT max(o_totalprice) AS top, min(o_totalprice) AS low, count(*) AS n, count(*) FILTER (o_orderdate >= TIMESTAMP '2001-07-25') AS recent FROM orders),
    r AS (SELECT o_totalprice, row_number() OVER (ORDER BY o_totalprice) - 1 AS i FROM orders)
    SELECT top, low, n, recent, o_totalprice AS median FROM s JOIN r ON r.i = n // 2""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    median = A.upper_median(o, [], "o_totalprice", F.floor(F.col("o_totalprice") / 1000), "median")
    stats = o.agg(F.max("o_totalprice").alias("top"), F.min("o_totalprice").alias("low"), F.count_if(F.col("o_orderdate") >= F.lit("2001-07-25").cast("timestamp")).alias("recent"), F.count("*").alias("n"))
    return stats.join(median, "n")


@query("ag10_skip_reasons", with_sql(ITEMS, """
    SELECT CASE WHEN duplicate_status <> 'unique' THEN 'duplicate' WHEN source_status <> 'verified' THEN 'needs-source-fix' WHEN clinical_risk = 'high' THEN 'rejected' ELSE 'ready' END AS code, count(*) AS n FROM items GROUP BY 1"""))
def _(spark, sf):
    why = F.when(F.col("duplicate_status") != "unique", "duplicate").when(F.col("source_status") != "verified", "needs-source-fix").when(F.col("clinical_risk") == "high", "rejected").otherwise("ready")
    return A.histogram(items(spark, sf).select(F.array(why).alias("codes")), "codes")


@query("ag11_feed_diagnostic", with_sql(SQL_DIAGNOSTIC, "SELECT feed, items, strftime(newest, '%Y-%m-%d %H:%M:%S') AS newest, age_days, average_gap_days, canonical_coverage, relay_ratio, duplicate_guids FROM diag"))
def _(spark, sf):
    return events_diagnostic(spark, sf).withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss"))


@query("ag12_worst_status", """
    SELECT s_suppkey, CASE WHEN min(CASE WHEN l_suppkey IS NULL THEN 9 WHEN l_discount > 0.09 AND l_quantity > 49 THEN 1 WHEN l_quantity > 49 THEN 3 ELSE 5 END) = 1 THEN 'failing'
      WHEN min(CASE WHEN l_suppkey IS NULL THEN 9 WHEN l_quantity > 49 THEN 3 ELSE 5 END) = 3 THEN 'stale' WHEN count(l_suppkey) = 0 THEN 'degraded' ELSE 'healthy' END AS source_status
    FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey""")
def _(spark, sf):
    q = F.col("l_quantity") > 49
    feeds = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.when((F.col("l_discount") > 0.09) & q, "failing").when(q, "stale").otherwise("healthy").alias("status"))
    return A.worst_status(feeds, table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey", "status").select("s_suppkey", "source_status")


@query("ag13_issue_histogram", with_sql(ITEMS, "SELECT unnest(CASE lang WHEN 'es' THEN ['image-ownership-unknown'] WHEN 'fr' THEN ['licensed-without-proof'] WHEN 'de' THEN ['official-press-without-source'] ELSE [] END) AS code, count(*) AS n FROM items GROUP BY 1"))
def _(spark, sf):
    return A.histogram(items(spark, sf).select(R.image_issues().alias("codes")), "codes")


@query("ag15_review_batches", "SELECT source, count(*) AS n_rows, CAST(row_number() OVER (ORDER BY count(*) DESC, source) AS INTEGER) AS batch FROM documents GROUP BY source")
def _(spark, sf):
    return A.review_batches(table(spark, sf, "documents"), "source")


@query("ag16_ratios", """
    SELECT l_returnflag, round(sum(CAST(l_linenumber AS BIGINT)) / greatest(1, sum(CAST(l_quantity AS BIGINT))), 6) AS ctr, round(count(*) FILTER (l_linestatus = 'F') / count(*), 4) AS public_rate FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.sum(F.col("l_linenumber").cast("long")) / F.greatest(F.lit(1), F.sum(F.col("l_quantity").cast("long"))), 6).alias("ctr"),
        F.round(F.try_divide(F.count_if(F.col("l_linestatus") == "F"), F.count("*")), 4).alias("public_rate"),
    )


@query("ag17_runs_trend", """
    WITH r AS (SELECT CAST(ts AS DATE) AS run, count(*) AS v FROM events WHERE event_type = 'error' GROUP BY 1 ORDER BY 1 DESC LIMIT 7) SELECT count(*) AS runs, round(avg(v), 6) AS mean, CAST(min(v) AS BIGINT) AS low, CAST(max(v) AS BIGINT) AS high FROM r""")
def _(spark, sf):
    h = table(spark, sf, "events").where("event_type = 'error'").select(F.to_date("ts").alias("run"), F.lit(1).alias("v"))
    return A.last_runs_trend(h, "run", "v").withColumn("mean", F.round("mean", 6))


@query("ag18_distinct_counts", "SELECT count(DISTINCT user_id) AS user_id, count(DISTINCT event_type) AS event_type, count(DISTINCT props) AS props FROM events")
def _(spark, sf):
    return A.distinct_counts(table(spark, sf, "events"), ["user_id", "event_type", "props"])


@query("ag18_approximate_counts", "SELECT count(DISTINCT user_id) AS user_id, count(DISTINCT event_type) AS event_type, TRUE AS close FROM events")
def _(spark, sf):
    """Few values are counted exactly by the sketch; of many, the estimate has to be within 15 percent."""
    names = ["user_id", "event_type", "props"]
    near, exact = (A.distinct_counts(table(spark, sf, "events"), names, exact=e) for e in (False, True))
    both = near.crossJoin(exact.select(F.col("user_id").alias("users"), F.col("event_type").alias("types"), F.col("props").alias("all_props")))  # one row each
    close = (F.abs(F.col("props") - F.col("all_props")) <= F.col("all_props") * 0.15) & (F.abs(F.col("user_id") - F.col("users")) <= F.col("users") * 0.15)
    return both.select(F.col("users").alias("user_id"), "event_type", close.alias("close"))


@query("ag18_united_sketches", "SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT props) AS props, TRUE AS close FROM events GROUP BY 1")
def _(spark, sf):
    """Sketches are stored per day and united; the exact counts stand beside the estimates, which have to be within 5 percent (three
    standard errors), or within one of a few."""
    e = table(spark, sf, "events")
    path = shared_folder(spark, "sketches")
    A.period_sketches(e, F.to_date("ts"), ["event_type"], ["user_id", "props"]).write.partitionBy("period").parquet(path)
    near = A.united_counts(spark.read.parquet(path), ["event_type"], ["user_id", "props"])
    exact = e.groupBy(F.col("event_type").alias("type")).agg(F.countDistinct("user_id").alias("users"), F.countDistinct("props").alias("all_props"))
    both = near.join(exact, near["event_type"].eqNullSafe(exact["type"]))
    within = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(F.col(b) * 0.05, F.lit(1))
    return both.select("event_type", "users", F.col("all_props").alias("props"), (within("user_id", "users") & within("props", "all_props")).alias("close"))


@query("ag19_newest_runs_median", """
    WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events)
    SELECT user_id, count(*) AS runs, list_sort(list(value))[1 + count(*) // 2] AS value FROM r WHERE rn <= 3 GROUP BY user_id""")
def _(spark, sf):
    return A.newest_runs_median(table(spark, sf, "events"), "user_id", [F.col("ts").desc(), F.col("event_id")], ["value"])


@query("ag20_month_index", """
    WITH e AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, min(o_orderkey) AS lead FROM orders GROUP BY 1)
    SELECT strftime(day, '%Y-%m') AS month, count(*) AS editions, CAST(sum(n) AS BIGINT) AS items, arg_max(lead, day) AS lead_title FROM e GROUP BY 1""")
def _(spark, sf):
    editions = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("lead"))
    return A.month_index(editions, "day", "n", "lead")
