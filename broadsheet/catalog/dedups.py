"""Queries for de-duplication (DD*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html, urls
from ..functions import text as tx
from ..operators import dedup, similarity
from . import query
from .identity import sql_title_key, sql_tokens
from .joins import SQL_SIM
from .tables import ART, ITEMS, articles, items, sql_normal_url, table, with_sql
from .texts import SQL_PAGE_TITLE


def candidates(spark, sf):
    """Documents with the keys of a candidate: its text and its title key."""
    return articles(spark, sf).select("doc_id", "lang", tx.title_key(F.col("title")).alias("title_key"), F.md5("text").alias("text_key"))


@query("dd1_keep_first_one_key", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY md5(text)")
def _(spark, sf):
    c = candidates(spark, sf)
    return dedup.keep_first_by_keys(c, "doc_id", "doc_id", F.array("text_key")).select("doc_id")


@query("dd1_keep_first_many_keys", with_sql("RECURSIVE " + ART, """
    , k AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS i, list_filter(['u:' || md5(text), 't:' || """ + sql_title_key("title") + """], lambda x: length(x) > 2) AS ks FROM art),
    s AS (SELECT 0::BIGINT AS i, FALSE AS kept, NULL::BIGINT AS doc_id, NULL::VARCHAR AS lang, []::VARCHAR[] AS seen
      UNION ALL SELECT k.i, NOT list_has_any(k.ks, s.seen), k.doc_id, k.lang, CASE WHEN list_has_any(k.ks, s.seen) THEN s.seen ELSE list_concat(s.seen, k.ks) END FROM s JOIN k ON k.i = s.i + 1)
    SELECT doc_id, lang FROM s WHERE kept"""))
def _(spark, sf):
    c = candidates(spark, sf)
    keys = F.array_distinct(F.filter(F.array(F.concat(F.lit("u:"), "text_key"), F.concat(F.lit("t:"), "title_key")), lambda k: F.length(k) > 2))
    return dedup.keep_first_by_keys(c, "doc_id", "doc_id", keys).select("doc_id", "lang")


@query("dd2_classify_entries", with_sql(ART + f", ts AS (SELECT doc_id, md5(text) AS k, list_sort({sql_tokens('title')}) AS words FROM art)", f"""
    , e AS (SELECT doc_id, words, lag(doc_id) OVER (PARTITION BY k ORDER BY doc_id) AS exact FROM ts),
    s AS (SELECT a.doc_id, a.exact, (SELECT min(b.doc_id) FROM ts b WHERE b.doc_id < a.doc_id AND len(a.words) > 0 AND len(b.words) > 0 AND {SQL_SIM} >= 0.9) AS prior FROM e a)
    SELECT doc_id, CASE WHEN exact IS NOT NULL THEN 'exact-duplicate' WHEN prior IS NOT NULL THEN 'update-of-existing' ELSE 'unique' END AS status, coalesce(exact, prior) AS duplicate_of FROM s"""))
def _(spark, sf):
    a = articles(spark, sf).select("doc_id", F.array_sort(tx.title_tokens(F.col("title"))).alias("words"), F.array(F.md5("text")).alias("keys"))
    return similarity.classify_entries(a, "doc_id", "doc_id", "keys", "words").select("doc_id", "status", "duplicate_of")


@query("dd3_newest_good_copy", with_sql(ITEMS, """
    , g AS (SELECT *, quality IS NULL OR quality = 1 AS good FROM items),
    r AS (SELECT doc_id, row_number() OVER (PARTITION BY source_url ORDER BY published_at DESC, doc_id) AS rn FROM g WHERE good)
    SELECT g.doc_id, CASE WHEN NOT good THEN 'quality' WHEN rn > 1 THEN 'duplicate-source' ELSE 'kept' END AS outcome FROM g LEFT JOIN r ON r.doc_id = g.doc_id"""))
def _(spark, sf):
    """A bad newer copy claims nothing, so the older good one survives."""
    i = items(spark, sf).withColumn("good", F.col("quality").isNull() | (F.col("quality") == 1))
    good = dedup.flag_later_copies(i.where("good"), "source_url", [-F.unix_micros("published_at"), F.col("doc_id")], "copy")
    marked = good.select("doc_id", F.when(F.col("copy"), "duplicate-source").otherwise("kept").alias("outcome"))
    return marked.unionByName(i.where("not good").select("doc_id", F.lit("quality").alias("outcome")))


@query("dd4_flag_later_copies", with_sql(ITEMS, "SELECT doc_id, row_number() OVER (PARTITION BY source_url ORDER BY date DESC, doc_id) > 1 AS duplicate_source FROM items"))
def _(spark, sf):
    i = dedup.flag_later_copies(items(spark, sf), "source_url", [-F.unix_date("date"), F.col("doc_id")])
    return i.select("doc_id", "duplicate_source")


@query("dd5_first_by_prefix", with_sql(ART, """
    , r AS (SELECT doc_id, substr(title, 1, 8) AS p, row_number() OVER (PARTITION BY substr(title, 1, 8) ORDER BY doc_id) AS rn FROM art WHERE title <> '') SELECT doc_id, p AS prefix FROM r WHERE rn = 1 ORDER BY doc_id LIMIT 100"""))
def _(spark, sf):
    return dedup.first_by_prefix(articles(spark, sf).select("doc_id", "title"), "title", [F.col("doc_id")], 8, 100).select("doc_id", F.substring("title", 1, 8).alias("prefix"))


@query("dd6_clear_repeated_images", with_sql(ITEMS, "SELECT doc_id, CASE WHEN count(*) OVER (PARTITION BY image_url) >= 2 THEN NULL ELSE image_url END AS image_url FROM items"))
def _(spark, sf):
    i = items(spark, sf).select("doc_id", "image_url", urls.image_key(F.col("image_url")).alias("key"))
    return dedup.clear_repeated(i, "key", "image_url").select("doc_id", "image_url")


@query("dd7_repeated_values", f"""
    WITH v AS (SELECT page_id, 'title' AS field, {SQL_PAGE_TITLE} AS value FROM pages UNION ALL SELECT page_id, 'canonical', {sql_normal_url('url')} FROM pages
      UNION ALL SELECT page_id, 'description', regexp_extract(html, '<h1>([^<]*)', 1) FROM pages)
    SELECT field, value, count(*) AS n_rows, min(page_id) AS first_row, CASE WHEN field = 'canonical' THEN 'critical' ELSE 'warning' END AS severity FROM v WHERE value <> '' GROUP BY field, value HAVING count(*) > 1""")
def _(spark, sf):
    values = {"title": html.page_title(F.col("html")), "canonical": urls.normalize_url(F.col("url")), "description": F.regexp_extract("html", "<h1>([^<]*)", 1)}
    return dedup.repeated_values(table(spark, sf, "pages"), "page_id", values)


@query("dd8_repeated_paragraph", with_sql(ART, "SELECT doc_id, len(list_distinct([regexp_replace(p, '\\s', '', 'g') for p in paragraphs])) < len(paragraphs) AS repeated FROM art"))
def _(spark, sf):
    return articles(spark, sf).select("doc_id", dedup.has_repeated_paragraph(F.col("paragraphs")).alias("repeated"))


@query("dd9_repeated_across", with_sql(ITEMS, """
    , f AS (SELECT doc_id, source_url, first_value(doc_id) OVER (PARTITION BY source_url ORDER BY published_at, doc_id) AS first_holder FROM items)
    SELECT doc_id, source_url, first_holder FROM f WHERE doc_id <> first_holder"""))
def _(spark, sf):
    return dedup.repeated_across(items(spark, sf), "source_url", "doc_id", [F.col("published_at"), F.col("doc_id")]).select("doc_id", "source_url", "first_holder")


@query("dd10_restore_seen", "SELECT DISTINCT user_id FROM events WHERE event_type = 'view' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 90)")
def _(spark, sf):
    e = table(spark, sf, "events")
    seen = e.where("event_type = 'view'").select("user_id").distinct()
    return dedup.restore_seen(seen, "user_id", e.where("event_type = 'error' AND value > 90").select("user_id"))


