"""Queries for window operators (WN*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup
from ..operators import windows as W
from . import query
from .rules import SQL_DIAGNOSTIC
from .tables import ITEMS, items, table, with_sql
from .texts import SQL_PAGE_TITLE


@query("wn1_capped_pick", with_sql(ITEMS, """
    , r AS (SELECT doc_id, source_label, value, row_number() OVER (PARTITION BY source_label ORDER BY value DESC, doc_id) AS rn FROM items) SELECT doc_id, source_label FROM r WHERE rn <= 5 ORDER BY value DESC, doc_id LIMIT 60"""))
def _(spark, sf):
    return W.capped_pick(items(spark, sf), "source_label", [F.col("value").desc(), F.col("doc_id")], 5, 60).select("doc_id", "source_label")


@query("wn2_round_robin", "SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS turn, user_id FROM events")
def _(spark, sf):
    e = table(spark, sf, "events")
    return W.round_robin(e, "user_id", "user_id", F.date_trunc("day", F.col("ts")), [F.col("ts"), F.col("event_id")]).select("event_id", "turn", "user_id")


@query("wn3_average_gap", with_sql(SQL_DIAGNOSTIC, "SELECT feed AS user_id, items AS n, average_gap_days FROM diag"))
def _(spark, sf):
    return W.average_gap(table(spark, sf, "events"), "user_id", "ts")


@query("wn4_success_streak", """
    WITH f AS (SELECT user_id, max(event_id) AS failed FROM events WHERE event_type = 'error' GROUP BY 1)
    SELECT e.user_id AS feed, least(20, count(*) FILTER (event_type <> 'error' AND (failed IS NULL OR event_id > failed))) AS consecutive_successes FROM events e LEFT JOIN f ON f.user_id = e.user_id GROUP BY 1""")
def _(spark, sf):
    runs = table(spark, sf, "events").select(F.col("user_id").alias("feed"), "event_id", (F.col("event_type") != "error").alias("ok"))
    return W.success_streak(runs, "feed", "event_id", "ok")


@query("wn5_latest_per_key", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def _(spark, sf):
    return dedup.first_per_key(table(spark, sf, "events"), ["user_id"], [F.col("event_id").desc()]).select("user_id", "event_id", "event_type")


@query("wn6_last_runs_ok", """
    WITH r AS (SELECT user_id, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
    SELECT user_id, bool_and(ok) AND count(*) >= 3 AS all_ok, count(*) AS runs FROM r WHERE rn <= 3 GROUP BY 1""")
def _(spark, sf):
    runs = table(spark, sf, "events").select("user_id", "event_id", (F.col("event_type") != "error").alias("ok"))
    return W.last_runs_ok(runs, "user_id", [F.col("event_id").desc()], "ok")


@query("wn7_edition_rank", "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderdate) AS edition FROM orders")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return W.edition_rank(o, "day").select("o_orderkey", "edition")


@query("wn8_edition_neighbours", with_sql(ITEMS, "SELECT doc_id, lag(doc_id) OVER (PARTITION BY date ORDER BY doc_id) AS prev_id, lead(doc_id) OVER (PARTITION BY date ORDER BY doc_id) AS next_id FROM items"))
def _(spark, sf):
    i = items(spark, sf).select("doc_id", "date")
    return W.edition_neighbours(i, "date", "doc_id", "doc_id", 7).select("doc_id", "prev_id", "next_id")


SQL_FILL = """have AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
c AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'O'),
p AS (SELECT c.*, coalesce(have.n, 0) AS have FROM c LEFT JOIN have ON have.day = c.day WHERE rn <= greatest(0, 5 - coalesce(have.n, 0)))"""


def fill(spark, sf):
    o = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    return W.daily_fill(o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'F'"), "day", [F.col("o_totalprice").desc(), F.col("o_orderkey")], 5)


@query("wn9_daily_fill", with_sql(SQL_FILL, "SELECT o_orderkey, CAST(rn AS INTEGER) AS release_rank FROM p"))
def _(spark, sf):
    return fill(spark, sf)[0].select("o_orderkey", "release_rank")


@query("wn9_shortfall", with_sql(SQL_FILL, """
    , n AS (SELECT day, count(*) AS r FROM p GROUP BY day) SELECT strftime(coalesce(n.day, have.day), '%Y-%m-%d') AS day, coalesce(r, 0) AS released, greatest(0, 5 - coalesce(r, 0) - coalesce(have.n, 0)) AS shortfall FROM n FULL JOIN have ON have.day = n.day"""))
def _(spark, sf):
    return fill(spark, sf)[1].withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("wn10_disambiguate_titles", f"""
    WITH p AS (SELECT page_id, {SQL_PAGE_TITLE} AS title FROM pages), k AS (SELECT page_id, title || ' · 2024-01-31' AS k FROM p)
    SELECT page_id, CASE WHEN count(*) OVER (PARTITION BY k) > 1 THEN k || ' · ' || page_id ELSE k END AS page_title FROM k""")
def _(spark, sf):
    from ..functions import html

    p = table(spark, sf, "pages").select("page_id", html.page_title(F.col("html")).alias("title"), F.lit("2024-01-31").alias("day"))
    return W.disambiguate_titles(p, "title", "day", "page_id").select("page_id", "page_title")


@query("wn11_mark_deep", with_sql(ITEMS, "SELECT doc_id, row_number() OVER (ORDER BY value DESC, doc_id) <= 15 AS deep FROM items"))
def _(spark, sf):
    return W.mark_deep(items(spark, sf).select("doc_id", "value"), "doc_id", [F.col("value").desc(), F.col("doc_id")], 15).select("doc_id", "deep")
