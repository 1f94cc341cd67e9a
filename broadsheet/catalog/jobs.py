"""Queries for whole jobs (JB*) and the rules that only appear inside them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as tx
from ..functions import urls
from ..functions.patterns import settle
from ..operators import coverage, monitor, pages, similarity
from ..operators import rules as R
from ..plans import audits, publication, queue, selection
from . import query
from .identity import sql_title_key, sql_tokens
from .joins import DEMANDS, SQL_COVER, SQL_KEYWORDS, keywords, shown_articles
from .rules import ITEMS_Q, SQL_CLAIMS, SQL_DIAGNOSTIC, SQL_EVALUATED, SQL_INDEXABLE, joined, rx, sql_codes
from .tables import ART, DATED, ITEMS, articles, dated, items, now, sql_normal_url, sql_path, sql_strip, table, with_sql
from .texts import SQL_PAGE_TITLE, sql_paras


# --- Pages ----------------------------------------------------------------------------------------------


def headed_pages(spark, sf):
    """pages with a head by page number: complete, without description, noindex with another canonical, or none."""
    p, n = table(spark, sf, "pages"), F.col("page_id") % 4
    url = F.concat(F.lit("https://news.example.com/article/"), F.col("page_id").cast("string"))
    title = F.concat(F.lit("<title>Page number "), F.col("page_id").cast("string"), F.lit("</title>"))
    og = F.concat(F.lit('<meta content="'), url, F.lit('" property="og:url"><meta property="og:title" content="T"><meta property="og:description" content="D"><meta property="og:image" content="https://i.example.com/a.png">'))
    canonical = F.concat(F.lit('<link href="'), url, F.lit('" rel="canonical">'))
    desc = F.lit('<meta name="description" content="A description that is long enough to pass.">')
    ld = F.concat(F.lit('<script type="application/ld+json">{"@type":"NewsArticle","url":"'), url, F.lit('","headline":"h","image":"i"}</script>'))
    head = (
        F.when(n == 0, F.concat(title, og, canonical, desc, ld)).when(n == 1, F.concat(title, og, canonical, ld))
        .when(n == 2, F.concat(title, og, F.lit('<link rel="canonical" href="https://other.example.com/"><meta name="robots" content="NOINDEX, follow">'), desc, F.lit('<script type="application/ld+json">{"@type":["WebPage"]}</script><script type="application/ld+json">{oops</script>')))
        .otherwise(title)
    )
    return p.select("page_id", url.alias("url"), F.concat(head, F.regexp_replace("html", "(?i)<title>[^<]*</title>", "")).alias("html"))


@query("cl27_page_contract", """
    SELECT page_id, 'article' AS kind, CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'description-invalid' WHEN 2 THEN 'canonical-mismatch,sitemap-page-noindex,jsonld-parse-error,primary-jsonld-missing'
      ELSE 'canonical-missing,description-invalid,og-url-mismatch,og-title-missing,og-description-missing,article-og-image-missing,primary-jsonld-missing' END AS codes FROM pages""")
def _(spark, sf):
    return pages.page_contract(headed_pages(spark, sf)).select("page_id", "kind", joined("codes").alias("codes"))


@query("cl28_article_checks", """
    SELECT page_id, CASE page_id % 4 WHEN 2 THEN 'article-jsonld-invalid,article-canonical-mismatch,article-noindex,article-jsonld-article-type-missing' WHEN 3 THEN 'article-canonical-missing,article-jsonld-article-type-missing' ELSE '' END AS codes FROM pages""")
def _(spark, sf):
    return pages.article_checks(headed_pages(spark, sf)).select("page_id", joined("codes").alias("codes"))


@query("cl28_homepage_checks", """
    SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'homepage-main-missing,homepage-search-action-missing,homepage-archive-link-missing,homepage-edition-below-minimum,homepage-static-items-below-minimum'
      WHEN 1 THEN 'homepage-issue-invalid,homepage-main-missing,homepage-search-action-missing,homepage-archive-link-missing' ELSE 'homepage-issue-missing,homepage-main-missing,homepage-search-action-missing,homepage-archive-link-missing' END
      || CASE WHEN regexp_matches(html, 'href=["'']/(article|issues/)[^"'']+', 'i') THEN '' ELSE ',homepage-article-links-missing' END AS codes FROM pages""")
def _(spark, sf):
    n = F.col("page_id") % 3
    inline = F.when(n == 0, '<script id="edition-data" type="application/json">' + '{"count": 3, "articles": [{}, {}]}</script>').when(n == 1, '<script id="edition-data">' + '{bad</script>').otherwise("")
    p = table(spark, sf, "pages").select("page_id", F.concat(inline, "html").alias("html"))
    return pages.homepage_checks(p, "edition-data").select("page_id", joined("codes").alias("codes"))


@query("ag14_page_reasons", """
    SELECT CASE WHEN page_id % 4 = 2 THEN 'noindex' WHEN page_id % 4 = 3 THEN 'canonical-missing' ELSE 'ok' END AS reason, count(*) AS n FROM pages GROUP BY 1""")
def _(spark, sf):
    meta = pages.with_meta(headed_pages(spark, sf))
    reason = F.when(F.contains("robots", F.lit("noindex")), "noindex").when(F.col("canonical") == "", "canonical-missing").otherwise("ok")
    return meta.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


# --- Monitors -------------------------------------------------------------------------------------------


@query("cl29_freshness", """
    WITH e AS (SELECT user_id, max(CAST(ts AS DATE)) AS latest, count(*) AS n FROM events GROUP BY 1)
    SELECT user_id, array_to_string(list_filter([CASE WHEN latest > DATE '2024-01-29' THEN 'latest-date-in-future' END, CASE WHEN DATE '2024-01-29' - latest > 1 THEN 'latest-stale' END, CASE WHEN user_id % 10 = 0 THEN 'latest-count-mismatch' END,
      CASE WHEN n < 60 THEN 'latest-below-minimum' END], lambda x: x IS NOT NULL), ',') AS codes FROM e""")
def _(spark, sf):
    e = table(spark, sf, "events").groupBy("user_id").agg(F.date_format(F.max("ts"), "yyyy-MM-dd").alias("latest"), F.count("*").alias("n"))
    declared = F.when(F.col("user_id") % 10 == 0, F.col("n") + 1).otherwise(F.col("n"))
    return e.select("user_id", joined(monitor.freshness(F.col("latest"), F.lit("2024-01-29"), F.col("n"), declared, 1, 60)).alias("codes"))


@query("cl30_manifest_checks", """
    WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS without_key FROM orders GROUP BY 1)
    SELECT month, array_to_string(list_filter([CASE WHEN month LIKE '%-01' THEN 'search-count-mismatch' END, CASE WHEN without_key > 0 THEN 'search-item-key-missing' END], lambda x: x IS NOT NULL), ',') AS search_codes,
      array_to_string(list_filter([CASE WHEN month LIKE '%-01' THEN 'search-manifest-count-mismatch' END], lambda x: x IS NOT NULL), ',') AS manifest_codes, 'archive-weeklies-invalid' AS archive_codes,
      CASE WHEN month LIKE '%-02' THEN 'deployment-source-commit-invalid' ELSE '' END AS deployment_codes FROM m""")
def _(spark, sf):
    m = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("without_key"))
    jan = F.endswith("month", F.lit("-01"))
    declared = F.when(jan, F.col("n") + 1).otherwise(F.col("n"))
    commit = F.when(F.endswith("month", F.lit("-02")), "main").otherwise("0123abc")
    dep = monitor.deployment(F.lit(1), now(), F.concat("month", F.lit("-01")), commit, {"searchCount": F.col("n")})
    return m.select(
        "month", joined(monitor.search_payload(F.col("n"), declared, F.col("without_key"))).alias("search_codes"),
        joined(monitor.search_manifest(declared, F.col("n"), F.lit(1))).alias("manifest_codes"), joined(monitor.archive_payload(F.col("n"), F.lit(None))).alias("archive_codes"), joined(dep).alias("deployment_codes"),
    )


@query("cl34_snapshot_issues", """
    SELECT 'current-duplicate-ids' AS reason, count(*) AS n FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1) HAVING count(*) > 0 UNION ALL SELECT 'current-count-mismatch', count(*) FROM lineitem""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("id"))
    return monitor.snapshot_issues(rows, ["id"], F.lit(1), "current")


# --- Updates and source resolution ------------------------------------------------------------------------


SQL_NUMBERS = r"array_to_string([trim(regexp_replace(x, '\s+', ' ', 'g')) for x in regexp_extract_all(body, '\b\d+(?:[,.]\d+)?\s*(?:mg|μg|mcg|mL|ml|IU|%|개월|주|일|마리|명|세)?\b', 0, 'i')], '|')"
SQL_UPDATES = ART + f""",
k AS (SELECT a.*, doc_id % 7 AS k, coalesce(l.quality, 1) = 1 AS verified FROM art a LEFT JOIN labels l USING (doc_id) WHERE doc_id % 3 = 0),
c AS (SELECT 'c' || doc_id AS id, verified, CASE WHEN k IN (2, 3, 4) THEN 'Revised note ' || doc_id WHEN k = 6 THEN 'Fresh words of number ' || doc_id WHEN k = 1 AND doc_id % 2 = 1 THEN title || ' extra' ELSE title END AS title,
    CASE WHEN k IN (0, 2, 3, 4) THEN 'https://' || lang || '.example.com/a/' || doc_id ELSE 'https://new.example.com/' || doc_id END AS url, CASE WHEN k = 5 THEN 'https://raw.example.com/' || doc_id END AS raw,
    title || ' ' || coalesce(paragraphs[1], '') || ' ' || array_to_string(paragraphs, ' ') || CASE WHEN k = 3 THEN ' 25 mg' WHEN k = 4 THEN ' correction 30 mg' ELSE '' END AS body FROM k),
p AS (SELECT doc_id, title, 'https://' || lang || '.example.com/a/' || doc_id AS url, 'https://raw.example.com/' || doc_id AS raw, title || ' ' || coalesce(paragraphs[1], '') || ' ' || array_to_string(paragraphs, ' ') AS body FROM art),
cw AS (SELECT *, list_sort({sql_tokens('title')}) AS words, {SQL_NUMBERS} AS numbers, regexp_matches(body, '{C.CORRECTION_WORDS.replace('(?i)', '')}', 'i') AS corrects FROM c),
pw AS (SELECT *, list_sort({sql_tokens('title')}) AS words, {SQL_NUMBERS} AS numbers FROM p),
s AS (SELECT c.id, p.doc_id, CASE WHEN len(c.words) > 0 AND len(p.words) > 0 THEN round(len(list_intersect(c.words, p.words)) / greatest(len(c.words), len(p.words)), 3) ELSE 0.0 END AS sim, c.url = p.url AS same_url, coalesce(c.raw = p.raw, FALSE) AS same_raw, c.numbers = p.numbers AS same_numbers FROM cw c CROSS JOIN pw p),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY greatest(sim, CASE WHEN same_url THEN 1.0 ELSE 0.0 END) DESC, doc_id) AS rn FROM s WHERE sim >= 0.72 OR same_url),
u AS (SELECT c.id, b.doc_id::VARCHAR AS match_id, CASE WHEN b.doc_id IS NULL THEN CASE WHEN verified THEN 'separate-story' ELSE 'unresolved' END
    WHEN (same_url OR same_raw) AND same_numbers THEN CASE WHEN sim >= 0.9 THEN 'duplicate' ELSE 'minor-update' END WHEN (same_url OR same_raw) AND corrects THEN 'correction' WHEN same_url OR same_raw THEN 'substantive-update'
    WHEN sim >= 0.9 THEN 'duplicate' ELSE 'unresolved' END AS class FROM cw c LEFT JOIN b ON b.id = c.id AND b.rn = 1)"""


@query("cl19_update_class", with_sql(SQL_UPDATES, "SELECT id, match_id, class FROM u"))
def _(spark, sf):
    """Every third document comes again: with its old title and URL, renamed, with other numbers, as a correction, under another
    URL that shares the raw one, or as a story of its own."""
    n, k = F.col("doc_id").cast("string"), F.col("doc_id") % 7
    own = lambda host: F.concat(F.lit(f"https://{host}.example.com/"), n)
    none = F.lit(None).cast("string")
    a = articles(spark, sf).withColumn("lead", F.coalesce(F.try_element_at("paragraphs", F.lit(1)), F.lit("")))
    url = F.concat(F.lit("https://"), "lang", F.lit(".example.com/a/"), n)
    body = selection.update_text("title", "lead", "paragraphs")
    prior = a.select(n.alias("id"), F.col("doc_id").alias("ord"), "title", url.alias("url"), F.array(own("raw"), none).alias("more_urls"), body.alias("body"))
    verified = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("_q"))
    title = F.when(k.isin(2, 3, 4), F.concat(F.lit("Revised note "), n)).when(k == 6, F.concat(F.lit("Fresh words of number "), n)).when((k == 1) & (F.col("doc_id") % 2 == 1), F.concat("title", F.lit(" extra"))).otherwise(F.col("title"))
    added = F.when(k == 3, " 25 mg").when(k == 4, " correction 30 mg").otherwise("")
    cand = a.where("doc_id % 3 = 0").join(verified, "doc_id", "left").select(
        F.concat(F.lit("c"), n).alias("id"), title.alias("title"), F.when(k.isin(0, 2, 3, 4), url).otherwise(own("new")).alias("url"), F.array(F.when(k == 5, own("raw")), none).alias("more_urls"),
        F.concat(body, added).alias("body"), (F.coalesce("_q", F.lit(1)) == 1).alias("verified"),
    )
    return selection.detect_updates(cand, prior).select("id", "match_id", "class")


@query("cl21_resolution_status", with_sql(ITEMS, """
    SELECT doc_id, CASE WHEN quality = 1 AND lang = 'en' THEN 'manually-approved' WHEN quality = 0 THEN 'rejected' WHEN value >= 92 AND user_id <= 30 THEN 'resolved' WHEN value >= 62 THEN 'candidate' ELSE 'unresolved' END AS status FROM items"""))
def _(spark, sf):
    decision = F.when(F.col("quality") == 1, "manually-approved").when(F.col("quality") == 0, "rejected")
    sim = F.when(F.col("value") >= 62, F.col("value") / 100)
    gap = F.when(F.col("user_id") <= 30, F.lit(1.0)).otherwise(F.lit(9.0))
    i = items(spark, sf)
    return i.select("doc_id", R.resolution_status(decision, F.col("lang") == "en", sim, gap).alias("status"))


# --- Selection --------------------------------------------------------------------------------------------


@query("jb1_collect_candidates", with_sql("RECURSIVE " + DATED, """
    , n AS (SELECT *, md5(text) AS h, CAST(regexp_extract(source, '(\\d+)', 1) AS BIGINT) AS feed_ord FROM dated),
    l AS (SELECT *, CASE lang WHEN 'en' THEN 0 WHEN 'es' THEN 2 ELSE 1 END AS part,
      CASE WHEN lang IN ('fr', 'de') THEN row_number() OVER (PARTITION BY lang IN ('fr', 'de'), source ORDER BY doc_id) ELSE doc_id END AS a, CASE WHEN lang IN ('fr', 'de') THEN feed_ord ELSE 0 END AS b FROM n),
    k AS (SELECT doc_id, h, row_number() OVER (ORDER BY part, a, b, 'd' || doc_id) AS i, list_filter(['u:' || h, 't:' || """ + sql_title_key("title") + """], lambda x: length(x) > 2) AS ks FROM l),
    s AS (SELECT 0::BIGINT AS i, FALSE AS kept, NULL::BIGINT AS doc_id, NULL::VARCHAR AS h, []::VARCHAR[] AS seen
      UNION ALL SELECT k.i, NOT list_has_any(k.ks, s.seen), k.doc_id, k.h, CASE WHEN list_has_any(k.ks, s.seen) THEN s.seen ELSE list_concat(s.seen, k.ks) END FROM s JOIN k ON k.i = s.i + 1)
    SELECT 'd' || doc_id AS id FROM s WHERE kept AND h NOT IN (SELECT h FROM n WHERE doc_id % 9 = 0)"""))
def _(spark, sf):
    a = dated(spark, sf).select(
        F.concat(F.lit("d"), "doc_id").alias("id"), "title", F.array(F.concat(F.lit("https://example.com/"), F.md5("text"))).alias("keys"), F.col("doc_id").alias("ord"), "lang", "source", "value",
        F.regexp_extract("source", r"(\d+)", 1).cast("long").alias("feed_ord"),
    )
    direct = a.where("lang = 'en'").select("id", "title", "keys", "ord")
    news = a.where("lang IN ('fr', 'de')").select("id", "title", "keys", "ord", F.col("source").alias("feed"), "feed_ord")
    social = a.where("lang = 'es'").select("id", "title", "keys", "ord", F.col("value").alias("score"))
    seen = a.where("ord % 9 = 0").select(F.explode("keys").alias("key"))
    return selection.collect_candidates(direct, news, social, seen, F.floor(F.col("ord") / 1000)).select("id")


@query("jb1_score_and_split", with_sql(ART, """
    , s AS (SELECT a.doc_id, md5(a.text) AS url, CASE WHEN quality IS NULL THEN NULL ELSE quality * 4 + toxic * 3 END AS relevance FROM art a LEFT JOIN labels l ON l.doc_id = a.doc_id),
    d AS (SELECT *, 'deep' AS tier FROM s WHERE coalesce(relevance, 0) >= 5 ORDER BY relevance DESC, doc_id LIMIT 42),
    b AS (SELECT *, 'brief' AS tier FROM s WHERE relevance >= 3 AND relevance < 5 AND url NOT IN (SELECT url FROM d) ORDER BY relevance DESC, doc_id LIMIT 90)
    SELECT doc_id, tier, relevance FROM d UNION ALL SELECT doc_id, tier, relevance FROM b"""))
def _(spark, sf):
    """The labels stand in for the outside scorer."""
    a = articles(spark, sf).select("doc_id", F.md5("text").alias("url"))
    labels = table(spark, sf, "labels").select("doc_id", (F.col("quality") * 4 + F.col("toxic") * 3).alias("relevance"))
    return selection.score_and_split(a, lambda df: labels.join(df, "doc_id", "left_semi"), "doc_id", "url", [F.col("doc_id")], C.ITEMS_PER_ISSUE, C.BRIEFS_PER_ISSUE).select("doc_id", "tier", "relevance")


SQL_INGEST = DATED + f""",
w AS (SELECT *, md5(text) AS k, list_sort({sql_tokens('title')}) AS words FROM dated),
e AS (SELECT *, lag(doc_id) OVER (PARTITION BY k ORDER BY doc_id) AS exact FROM w),
u AS (SELECT * FROM e WHERE exact IS NULL AND NOT EXISTS (SELECT 1 FROM w b WHERE b.doc_id < e.doc_id AND len(b.words) > 0 AND len(e.words) > 0 AND round(len(list_intersect(e.words, b.words)) / greatest(len(e.words), len(b.words)), 3) >= 0.9)),
r AS (SELECT * FROM u WHERE regexp_matches(title || ' ' || text, 'cat|tion', 'i') AND 'https://example.com/' || k NOT IN (SELECT 'https://example.com/' || md5(text) FROM documents WHERE doc_id % 11 = 0)),
s AS (SELECT *, 0.40 * greatest(0.0, 1 - abs((epoch_us(TIMESTAMP '2024-01-05') - epoch_us(ts)) / 86400000000.0) / 30) + 0.25 * least(1.0, length(text) / 600)
   + 0.20 * least(1.0, len(list_distinct([lower(t) for t in regexp_extract_all(title || ' ' || text, '{C.RELEVANCE_TERMS}', 0, 'i')])) / 4) + 0.10 * (CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END) + 0.05 * 0.5 AS score FROM r),
q AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rn FROM s),
t AS (SELECT * FROM q WHERE rn <= 8 ORDER BY score DESC, doc_id LIMIT 100)"""


@query("jb2_ingest", with_sql(SQL_INGEST, "SELECT doc_id AS id, round(score, 4) AS selection_score, row_number() OVER (ORDER BY score DESC, doc_id) <= 15 AS deep FROM t"))
def _(spark, sf):
    d = dated(spark, sf).select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), "title", F.col("text").alias("description"), F.col("source").alias("source_id"), F.col("ts").alias("published_at"),
        (F.col("lang") == "en").alias("has_canonical"), F.lit(50).alias("priority"), F.array(F.concat(F.lit("https://example.com/"), F.md5("text"))).alias("url_keys"), F.array_sort(tx.title_tokens(F.col("title"))).alias("words"),
    )
    status = similarity.classify_entries(d.select("id", "ord", "url_keys", "words"), "id", "ord", "url_keys", "words")
    seen = d.where("id % 11 = 0").select(F.explode("url_keys").alias("key"))
    return selection.ingest(d, status, seen, F.lit("2024-01-05").cast("timestamp"), 100, 8, 15, "cat|tion").select("id", "selection_score", "deep")


@query("jb14_update_counts", with_sql(SQL_UPDATES, "SELECT class, count(*) AS n FROM u GROUP BY 1"))
def _(spark, sf):
    from . import QUERIES

    return QUERIES["cl19_update_class"](spark, sf).groupBy("class").agg(F.count("*").alias("n"))


# --- Publication ------------------------------------------------------------------------------------------




@query("jb3_repair", with_sql(ITEMS_Q, """
    , v AS (SELECT * FROM iq WHERE coalesce(visibility, '') <> 'suppressed'), g AS (SELECT source_url, min(struct_pack(a := -epoch_us(published_at), b := doc_id)) AS first FROM v WHERE len(publish_codes) = 0 GROUP BY 1),
    d AS (SELECT v.doc_id, v.publish_codes, g.first IS NOT NULL AND g.first < struct_pack(a := -epoch_us(v.published_at), b := v.doc_id) AS dup FROM v LEFT JOIN g ON g.source_url = v.source_url)
    SELECT doc_id, array_to_string(list_sort(list_concat(publish_codes, CASE WHEN dup THEN ['duplicate-source'] ELSE [] END)), ',') AS reasons FROM d WHERE dup OR len(publish_codes) > 0"""))
def _(spark, sf):
    out = publication.repair(items(spark, sf), "doc_id", "source_url", [-F.unix_micros("published_at"), F.col("doc_id")])
    return out.select("doc_id", joined(F.array_sort("reasons")).alias("reasons"))


@query("jb3_repair_report", with_sql(ITEMS_Q, "SELECT unnest(publish_codes) AS reason, count(*) AS n FROM iq WHERE coalesce(visibility, '') <> 'suppressed' GROUP BY 1"))
def _(spark, sf):
    codes = settle(items(spark, sf).where(F.coalesce("visibility", F.lit("")) != "suppressed"), reasons=R.publish_issues())
    return publication.repair_report(codes)


@query("jb4_build_index", with_sql(ITEMS_Q, f"""
    , m AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY image_url) > 1 THEN NULL ELSE image_url END AS image FROM iq),
    x AS (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY date DESC, doc_id) > 1 AS duplicate FROM m WHERE title <> '' AND len(paragraphs) > 0)
    SELECT doc_id, duplicate, image, {SQL_INDEXABLE} AND NOT duplicate AS indexable FROM x"""))
def _(spark, sf):
    i = publication.build_index(items(spark, sf), "doc_id", "source_url", [-F.unix_date("date"), F.col("doc_id")], ["date", "source_label"])
    return i.select("doc_id", "duplicate", F.col("image_url").alias("image"), "indexable")


@query("jb4_weeklies", with_sql(ITEMS_Q, """
    , r AS (SELECT doc_id, strftime(date, '%G-W%V') AS week, row_number() OVER (PARTITION BY strftime(date, '%G-W%V') ORDER BY relevance DESC, doc_id) AS rank FROM iq WHERE renderable)
    SELECT doc_id, week, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 12 AND week IN (SELECT week FROM r GROUP BY 1 HAVING count(*) >= 3)"""))
def _(spark, sf):
    return publication.weeklies(items(spark, sf), "date", [F.col("relevance").desc(), F.col("doc_id")]).select("doc_id", "week", "rank")


def release_inputs(spark, sf):
    def as_brief(read):
        # Long Latin texts never pass the sentence rules, so drafts are judged as briefs with their text as lead.
        return read.withColumns({"content_tier": F.lit("brief"), "lead": F.col("_body"), "_lead": F.col("_body")})

    key = urls.normalize_url(F.col("source_url"))
    drafts = items(spark, sf, as_brief).withColumn("source_key", key).where("workflow_status IN ('draft', 'automated', 'approved')")
    return drafts, items(spark, sf).withColumn("source_key", key).where("workflow_status = 'published'")


# The same rules over drafts, whose text stands for their lead.
SQL_DRAFTS = (
    ITEMS_Q.replace("iqp AS (", "iqd AS (SELECT * REPLACE (body AS lead, 'brief' AS content_tier) FROM iq0 WHERE workflow_status IN ('draft', 'automated', 'approved')),\niqp AS (").replace("FROM iq0),\niq2", "FROM iqd),\niq2")
    + ", " + SQL_CLAIMS + "," + SQL_EVALUATED + f""",
pub AS (SELECT id, date, value, {sql_normal_url('source_url')} AS source_key FROM items WHERE workflow_status = 'published'),
days AS (SELECT source_key, min(date) AS a, max(date) AS z FROM pub WHERE source_key <> '' GROUP BY 1),
o0 AS (SELECT e.*, {sql_normal_url('e.source_url')} AS source_key FROM evaluated e),
o1 AS (SELECT o.*, CASE WHEN EXISTS (SELECT 1 FROM pub p WHERE p.date = o.date AND (p.id = o.id OR (p.source_key = o.source_key AND p.source_key <> ''))) THEN 'published-today' WHEN d.a <> o.date OR d.z <> o.date THEN 'published-before' ELSE status END AS judged
  FROM o0 o LEFT JOIN days d ON d.source_key = o.source_key),
o2 AS (SELECT *, CASE WHEN judged = 'ready-public-brief' AND source_key <> '' AND row_number() OVER (PARTITION BY judged, source_key ORDER BY doc_id) > 1 THEN 'published-before' ELSE judged END AS outcome FROM o1)"""
)


@query("jb10_release", with_sql(SQL_DRAFTS, f"""
    , h AS (SELECT date, count(*) AS have FROM pub WHERE value > 80 GROUP BY 1),
    k AS (SELECT id, date, grade, row_number() OVER (PARTITION BY date ORDER BY grade = 'index-news' DESC, index_candidate DESC, coalesce(selection_score, 0) DESC, id) AS n FROM o2 WHERE outcome = 'ready-public-brief')
    SELECT k.id, k.date, k.grade, CAST(k.n AS INTEGER) AS release_rank FROM k LEFT JOIN h ON h.date = k.date WHERE k.n <= greatest(0, {C.DAILY_TARGET} - coalesce(have, 0))"""))
def _(spark, sf):
    drafts, out = release_inputs(spark, sf)
    evaluated = publication.evaluate_release(drafts, out, "date", F.col("lang").isin("en", "fr"), F.col("doc_id"))
    picked, _ = publication.release(evaluated, out.where("value > 80"), "date", [F.col("id")])
    return picked.select("id", "date", "e.grade", "release_rank")


@query("jb10_outcomes", with_sql(SQL_DRAFTS, "SELECT outcome, count(*) AS n FROM o2 GROUP BY 1"))
def _(spark, sf):
    drafts, out = release_inputs(spark, sf)
    evaluated = publication.evaluate_release(drafts, out, "date", F.col("lang").isin("en", "fr"), F.col("doc_id"))
    return evaluated.groupBy("outcome").agg(F.count("*").alias("n"))


# --- Audits -------------------------------------------------------------------------------------------------


@query("jb5_validate_pages", f"""
    WITH e AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\\b[^>]+href=["'']([^"'']+)["'']', 1, 'i')) AS href FROM pages),
    t AS (SELECT {SQL_PAGE_TITLE} AS title FROM pages)
    SELECT 'duplicate-title' AS "check", title AS subject, CAST(count(*) AS VARCHAR) AS detail FROM t WHERE title <> '' GROUP BY title HAVING count(*) > 1
    UNION ALL SELECT 'broken-link', href, CAST(count(*) AS VARCHAR) FROM e WHERE href LIKE '/%' AND href NOT LIKE '//%' AND href NOT LIKE '/api/%' AND href NOT LIKE '/search%'
      AND regexp_replace(href, '[?#].*$', '') NOT IN (SELECT {sql_path('url')} FROM pages) GROUP BY href
    UNION ALL SELECT 'canonical-mismatch', url, '' FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT 'target-missing', url || '/gone', '' FROM pages WHERE page_id % 2 = 1""")
def _(spark, sf):
    p = table(spark, sf, "pages")
    sitemap = p.select(F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat("url", F.lit("/gone"))).alias("loc"))
    return audits.validate_pages(p, sitemap)


@query("jb6_seo_audit", """
    WITH c AS (SELECT page_id, unnest(string_split(CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'description-invalid' WHEN 2 THEN 'canonical-mismatch,sitemap-page-noindex,jsonld-parse-error,primary-jsonld-missing'
      ELSE 'canonical-missing,description-invalid,og-url-mismatch,og-title-missing,og-description-missing,article-og-image-missing,primary-jsonld-missing' END, ',')) AS code FROM pages
      UNION ALL SELECT page_id, CASE WHEN len(regexp_extract_all(regexp_replace(html, '<script(?s:.*?)</script>|<style(?s:.*?)</style>', ' ', 'gi'), '<p\\b', 0, 'i')) < 3 THEN 'index-under-three-paragraphs' ELSE '' END FROM pages)
    SELECT 'article' AS kind, code, count(*) AS n FROM c WHERE code <> '' GROUP BY code""")
def _(spark, sf):
    return audits.seo_audit(headed_pages(spark, sf))


@query("jb7_operations_summary", with_sql(ITEMS_Q, """
    , d AS (SELECT *, coalesce(quality = 1, FALSE) AS idx, CASE WHEN value > 80 THEN 'manually-approved' END AS decision, CASE WHEN role = 'vet' THEN FALSE ELSE reviewed_at IS NOT NULL END AS reviewed FROM iq)
    SELECT count(*) AS total, count(*) FILTER (idx) AS indexed, round(count(*) FILTER (idx) / count(*), 4) AS index_rate, count(*) FILTER (source_status = 'unresolved' AND decision IS NULL) AS unresolved,
      count(*) FILTER (idx AND publication_status <> 'index-news' AND NOT reviewed AND risk = 'high') AS high_waiting, count(*) FILTER (idx AND publication_status <> 'index-news' AND NOT reviewed AND risk = 'medium') AS medium_waiting,
      count(*) FILTER (lang = 'es' AND value <= 50) AS images_pending, count(*) FILTER (idx AND publication_status = 'index-news') AS automatic, count(*) FILTER (doc_id IN (SELECT event_id FROM events WHERE event_type = 'view')) AS with_review FROM d"""))
def _(spark, sf):
    i = R.facts(items(spark, sf))
    reviews = table(spark, sf, "events").where("event_type = 'view'").select(F.col("event_id").cast("string").alias("id"), F.col("event_id").alias("review_ord"), F.col("event_type").alias("new_status"))
    out = audits.operations_summary(
        i, reviews, i.where("quality = 1").select("id"), i.where("value > 80").select("id", F.lit("manually-approved").alias("status")), i.where("value > 50").select("id"),
    )
    return out.drop("can_increase_index", "needs_people")


def review_facts(spark, sf):
    """Items with the rule codes that reviews look at, without their texts."""
    return R.facts(items(spark, sf), quality_codes=R.quality_issues(), review_codes=R.review_issues(), numeric_codes=R.item_numeric_issues())


def editorial_rows(i):
    """Review rows of the items or their facts; without rule codes where these are missing."""
    none = F.array().cast("array<string>")
    codes = [F.col(n) if n in i.columns else none.alias(n) for n in ("quality_codes", "review_codes", "numeric_codes")]
    base = i.select(
        "id", "date", "title", "clinical_risk", "workflow_status", "reviewer_role", "source_label", (F.col("quality") == 1).alias("_idx"), F.col("reviewed_at").isNull().alias("reviewer_needed"),
        F.lit(False).alias("re_review"), *codes,
    )
    return base.withColumn("indexable", F.coalesce("_idx", F.lit(False))).drop("_idx")


SQL_TASKS = ITEMS_Q + ", " + SQL_CLAIMS + """,
ed AS (SELECT 'editorial:' || id AS id, CASE WHEN workflow_status = 'correction-required' THEN 'correction' ELSE 'editorial-review' END AS type,
   CASE WHEN workflow_status = 'correction-required' THEN 140 WHEN clinical_risk = 'high' THEN 115 WHEN clinical_risk = 'medium' THEN 95 ELSE 85 END AS priority, coalesce(quality = 1, FALSE) AS indexable FROM cw
   WHERE workflow_status = 'correction-required' OR list_has_any(claim_codes, ['numeric-lead-body-mismatch', 'numeric-radar-body-mismatch']) OR (reviewed_at IS NULL AND quality = 1 AND clinical_risk IN ('high', 'medium'))),
tk AS (SELECT * FROM ed
  UNION ALL SELECT 'source:' || id, 'source-review', CASE WHEN quality = 1 THEN 125 ELSE 75 END, coalesce(quality = 1, FALSE) FROM items WHERE source_status = 'unresolved'
  UNION ALL SELECT 'image:' || id, 'image-rights', CASE WHEN quality = 1 THEN 105 ELSE 45 END, coalesce(quality = 1, FALSE) FROM items WHERE lang <> 'en'
  UNION ALL SELECT 'feed:' || user_id, 'feed-health', CASE WHEN user_id % 3 = 0 THEN 90 WHEN user_id % 3 = 1 THEN 65 ELSE 55 END, FALSE FROM (SELECT DISTINCT user_id FROM events)
  UNION ALL SELECT 'draft:' || id, 'draft-review', CASE WHEN clinical_risk = 'high' THEN 100 WHEN clinical_risk = 'medium' THEN 80 ELSE 50 END, FALSE FROM items WHERE workflow_status = 'draft'
  UNION ALL SELECT 'production:sync', 'production-sync', 150, FALSE
  UNION ALL SELECT 'public-correction:' || event_id, 'correction', CASE WHEN event_type = 'view' THEN 145 ELSE 135 END, FALSE FROM events WHERE event_type IN ('view', 'click') AND value > 95)"""


def full_queue(spark, sf):
    i, e = review_facts(spark, sf), table(spark, sf, "events")
    unresolved = i.where("source_status = 'unresolved'").select(F.col("id").alias("article_id"), "date", "title", F.lit("unresolved").alias("status"), "source_label", F.lit(None).cast("boolean").alias("indexable"))
    images = R.image_queue(i, i.select("id", F.lit("x").alias("status")).limit(0), i.where("quality = 1").select("id"))
    users = e.select("user_id").distinct()
    feeds = users.select(
        F.col("user_id").cast("string").alias("source_id"), F.col("user_id").cast("string").alias("source_label"), F.lit(500).alias("http_status"),
        F.when(F.col("user_id") % 3 == 0, "failing").when(F.col("user_id") % 3 == 1, "stale").otherwise("degraded").alias("status"),
    )
    drafts = i.where("workflow_status = 'draft'").select("id", "title", "clinical_risk", F.lit(False).alias("published"), "source_label", F.array().cast("array<string>").alias("warnings"))
    findings = e.where("event_type = 'error'").select(F.lit("critical").alias("severity"), F.lit("x").alias("reason"))
    corrections = e.where("event_type IN ('view', 'click', 'error') AND value > 95").select(
        F.col("event_id").cast("string").alias("id"), F.when(F.col("event_type") == "view", "fact").otherwise("other").alias("kind"), F.when(F.col("event_type") == "error", "closed").otherwise("").alias("status"), F.col("props").alias("message"),
    )
    return queue.work_queue(editorial_rows(i), unresolved, images, feeds, drafts, findings, corrections)


@query("jb8_work_queue", with_sql(SQL_TASKS, "SELECT id, type, priority, indexable FROM tk"))
def _(spark, sf):
    return full_queue(spark, sf).select("id", "type", "priority", "indexable")


@query("so5_union_tasks", with_sql(SQL_TASKS, "SELECT type, count(*) FILTER (priority >= 130) AS critical, count(*) FILTER (priority >= 90 AND priority < 130) AS high, count(*) FILTER (priority < 90) AS normal FROM tk GROUP BY type"))
def _(spark, sf):
    return queue.queue_report(full_queue(spark, sf))


@query("cl37_editorial_tasks", with_sql(SQL_TASKS, "SELECT id, type, priority, indexable FROM ed"))
def _(spark, sf):
    from ..operators import tasks

    return tasks.editorial_tasks(editorial_rows(review_facts(spark, sf))).select("id", "type", "priority", "indexable")


@query("cl41_enrich_drafts", with_sql(ITEMS_Q + ", " + SQL_CLAIMS, f"""
    SELECT doc_id, CASE clinical_risk WHEN 'high' THEN 100 WHEN 'medium' THEN 70 ELSE 40 END AS priority, array_to_string(list_concat(claim_codes, {sql_codes([(rx("title", C.TITLE_ENGLISH), "untranslated-title")])}), ',') AS warnings
    FROM cw WHERE workflow_status = 'draft'"""))
def _(spark, sf):
    from ..functions.patterns import codes, matches

    i = items(spark, sf)
    claims = i.select("id", R.claim_warnings().alias("warnings"))
    language = i.select("id", codes((matches(F.col("title"), C.TITLE_ENGLISH), "untranslated-title")).alias("warnings"))
    return queue.enrich_drafts(i.where("workflow_status = 'draft'"), claims, language).select("doc_id", "priority", joined("warnings").alias("warnings"))


@query("cl43_review_packets", with_sql(ITEMS_Q + ", " + SQL_CLAIMS, """
    SELECT id, risk, source_label AS label, source_status AS status, array_to_string([c for c in claim_codes if c LIKE 'numeric%'], ',') AS numeric FROM cw WHERE value > 20 AND risk IN ('medium', 'high')"""))
def _(spark, sf):
    i = items(spark, sf)
    p = queue.review_packets(i, i.where("value > 20").select("id"), F.lit(0))
    return p.select("id", "risk", "source.label", "source.status", joined("numeric_codes").alias("numeric"))


SQL_GAPS = f"{ART}, {SQL_KEYWORDS}, {SQL_COVER}, cn AS (SELECT keyword, count(*) AS n FROM cover GROUP BY 1)"


@query("cl42_keyword_gaps", with_sql(SQL_GAPS, """
    SELECT kw.keyword, volume, topic, coalesce(n, 0) AS articles, CASE WHEN volume >= 100 AND n IS NULL THEN 'gap' WHEN volume >= 100 THEN 'strong' ELSE 'small' END AS verdict FROM kw LEFT JOIN cn ON cn.keyword = kw.keyword"""))
def _(spark, sf):
    docs = shown_articles(spark, sf).select("doc_id", "title", "lead")
    return audits.keyword_gaps(keywords(spark, sf), docs, "doc_id", "title", "lead").select("keyword", "volume", "topic", "articles", "verdict")


KNOWN_WORDS = "ation|ther|tion|thin|ent|the|on|ci|es"


@query("jb9_content_kit", with_sql(SQL_GAPS, f"""
    , kn AS (SELECT keyword, list_distinct(regexp_extract_all(keyword, '{KNOWN_WORDS}')) AS known FROM kw WHERE volume >= 500),
    r AS (SELECT keyword, doc_id, row_number() OVER (PARTITION BY keyword ORDER BY doc_id) AS rank FROM kn JOIN art ON title <> '' AND n_chars > 1500
       AND (NOT contains(keyword, 'tion') OR contains(title, 'tion')) AND (NOT contains(keyword, 'es') OR contains(keyword, 'tion') OR contains(title, 'es'))
       WHERE len(known) >= 2 AND len([t for t in known if NOT contains(title || ' ' || text, t)]) = 0) SELECT keyword, doc_id, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5"""))
def _(spark, sf):
    """The first five documents with an angle (long ones) for each keyword, over their whole texts."""
    docs = shown_articles(spark, sf).select(
        "doc_id", F.concat_ws(" ", "title", "text").alias("haystack"),
        F.concat(coverage.classes_of(F.col("title"), [(n, p) for n, p, _ in DEMANDS]), F.when(F.col("n_chars") > 1500, F.array(F.lit("angle"))).otherwise(F.array().cast("array<string>"))).alias("classes"),
    )
    demands = F.concat(coverage.class_terms(F.col("keyword"), DEMANDS), F.array(F.lit(coverage.CLASS + "angle")))
    return audits.content_kit(keywords(spark, sf), docs, "doc_id", "haystack", "classes", KNOWN_WORDS, demands)


@query("jb11_diagnose_feeds", with_sql(SQL_DIAGNOSTIC, """
    , f AS (SELECT user_id, max(event_id) AS failed FROM events WHERE event_type = 'error' GROUP BY 1),
    k AS (SELECT e.user_id AS feed, count(*) FILTER (event_type <> 'error' AND (failed IS NULL OR event_id > failed)) AS streak FROM events e LEFT JOIN f ON f.user_id = e.user_id GROUP BY 1),
    s AS (SELECT diag.feed, streak, CASE WHEN diag.feed % 29 = 0 THEN 'disabled' WHEN diag.feed % 19 = 0 THEN 'failing' WHEN age_days > 7 AND (average_gap_days IS NULL OR average_gap_days > 14 OR items <= 2) THEN 'quiet'
       WHEN relay_ratio > 0 OR duplicate_guids > 20 THEN 'degraded' ELSE 'healthy' END AS st FROM diag JOIN k ON k.feed = diag.feed)
    SELECT feed, CASE WHEN st = 'healthy' AND streak < 3 THEN 'degraded' ELSE st END AS status FROM s"""))
def _(spark, sf):
    e = table(spark, sf, "events")
    entries = e.select(F.col("user_id").alias("feed"), "ts", F.col("event_id").alias("guid"), (F.col("event_type") != "signup").alias("canonical"), (F.col("value") > 99).alias("relay"))
    runs = e.select(F.col("user_id").alias("feed"), F.col("event_id").alias("run_ord"), (F.col("event_type") != "error").alias("ok"))
    dup = e.groupBy("user_id").agg((F.count("*") - F.countDistinct("props")).alias("d")).select(F.col("user_id").alias("feed"), (F.col("d") <= 20).alias("official"))
    f = F.col("feed")
    feeds = dup.select("feed", f.alias("source"), (f % 29 != 0).alias("enabled"), F.lit(False).alias("retired"), F.when(f % 19 == 0, 500).otherwise(200).alias("http"), "official", F.lit(True).alias("mime_ok"))
    return audits.diagnose_feeds(entries, runs, feeds, now()).select("feed", "status")


@query("jb12_audit_images", with_sql(ITEMS, """
    , m AS (SELECT *, count(*) OVER (PARTITION BY image_url) AS uses FROM items) SELECT doc_id, CASE WHEN uses < 2 THEN image_url END AS image_url,
      CASE WHEN uses < 2 AND lang = 'es' THEN 'image-ownership-unknown' WHEN lang = 'fr' THEN 'licensed-without-proof' WHEN lang = 'de' THEN 'official-press-without-source' ELSE '' END AS codes FROM m"""))
def _(spark, sf):
    return audits.audit_images(items(spark, sf), "image_url", F.col("source_url")).select("doc_id", "image_url", joined("image_codes").alias("codes"))


@query("jb13_retention_guard", """
    SELECT 'current-count-mismatch' AS reason, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT 'public-article-removed', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'""")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("id", F.col("o_orderkey").cast("string"))
    return audits.retention_guard(o, o.where("o_orderstatus <> 'F'"), o.where("o_orderpriority = '5-LOW'"), "id", F.lit(1))


SQL_BODY = f"""s AS (SELECT page_id, url, {SQL_PAGE_TITLE} AS title, {sql_paras("regexp_extract(html, '<article[^>]*>((?s:.*?))</article>', 1, 'i')")} AS a, {sql_paras('html')} AS w FROM pages),
c AS (SELECT page_id, url, title, CASE WHEN length(array_to_string(a, '')) >= 800 THEN a WHEN length(array_to_string(w, '')) >= 800 THEN w WHEN length(array_to_string(a, '')) >= length(array_to_string(w, '')) THEN a ELSE w END AS parts FROM s),
b AS (SELECT page_id, url, title, CASE WHEN length(array_to_string(parts, chr(10))) > 400 THEN array_to_string(parts, chr(10)) END AS body FROM c)"""


@query("jb15_extract_pages", with_sql(SQL_BODY, f"SELECT page_id, {sql_normal_url('url')} AS normal_url, 'v1_' || substr(sha256({sql_normal_url('url')}), 1, 16) AS item_id, title, body FROM b"))
def _(spark, sf):
    return audits.extract_pages(table(spark, sf, "pages")).drop("verdict")


