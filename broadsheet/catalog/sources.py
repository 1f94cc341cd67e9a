"""Queries for scans, sources and sinks (SC*, SK*). Payloads are built from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.patterns import squeeze
from ..operators import rules as R
from ..sources import feeds, papers, records, registry, sinks
from . import query
from .rules import ITEMS_Q
from .tables import DATED, ITEMS, NOW, dated, items, now, sql_host, sql_squeeze, table, with_sql

# XML 1.0 allows no control characters but tab and line breaks. They stand one by one, which Java looks up in one step.
XML_JUNK = "[" + "".join(f"\\x{c:02X}" for c in (*range(0x09), 0x0B, 0x0C, *range(0x0E, 0x20))) + "<>&\\uFFFE-\\uFFFF]"


def xml_safe(col):
    return F.regexp_replace(col, XML_JUNK, " ")


def sql_xml_safe(col):
    return f"regexp_replace({col}, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x{{FFFE}}\\x{{FFFF}}<>&]', ' ', 'g')"


def feed_payloads(spark, sf):
    """One feed payload per source, language and block of a hundred ids: RSS for English, Atom for the others."""
    d = dated(spark, sf)
    rss = F.col("lang") == "en"
    title, body = xml_safe(F.col("title")), xml_safe(F.col("text"))
    link = F.concat(F.lit("https://"), "lang", F.lit(".example.com/a/"), "doc_id", F.lit("?utm_source=feed#x"))
    entry = F.when(
        rss,
        F.concat(F.lit("<item><title>"), title, F.lit("</title><link>"), link, F.lit("</link><guid isPermaLink=\"false\">g"), "doc_id", F.lit("</guid><pubDate>"),
                 F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate><dc:identifier>doi:10.1234/"), "doc_id", F.lit("</dc:identifier><description><![CDATA[<p>"), body,
                 F.lit("</p>]]></description><source url=\"x\">Paper "), "source", F.lit("</source></item>")),
    ).otherwise(
        F.concat(F.lit("<entry><title type=\"text\">"), title, F.lit("</title><link rel=\"alternate\" href=\""), link, F.lit("\"/><id>g"), "doc_id", F.lit("</id><updated>"),
                 F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z</updated><summary>"), body, F.lit("</summary></entry>"))
    )
    grouped = d.withColumn("e", entry).groupBy("source", "lang", F.floor(F.col("doc_id") / 100).alias("block")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "e"))), lambda x: x["e"]), "").alias("es"))
    xml = F.when(F.col("lang") == "en", F.concat(F.lit('<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>t</title>'), "es", F.lit("</channel></rss>"))).otherwise(
        F.concat(F.lit('<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>'), "es", F.lit("</feed>"))
    )
    return grouped.select(
        F.col("source").alias("source_id"), F.upper("source").alias("source_label"), F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("block").cast("string")).alias("feed_url"),
        F.array(F.lit("en.example.com"), F.lit("fr.example.com")).alias("domains"), xml.alias("xml"), F.lit("application/xml").alias("content_type"), (F.col("lang") == "en").alias("is_news"), F.col("lang").alias("market"),
    )


@query("sc2_read_feeds", with_sql(DATED, f"""
    SELECT source AS source_id, 'g' || doc_id AS guid, {sql_squeeze(sql_xml_safe('title'))} AS title, 'https://' || lang || '.example.com/a/' || doc_id AS url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS published,
      CASE WHEN lang = 'en' THEN '10.1234/' || doc_id END AS doi, CASE WHEN lang = 'en' THEN 'https://en.example.com/a/' || doc_id END AS canonical_url,
      {sql_squeeze(sql_xml_safe('text'))} AS description, lang IN ('en', 'fr') AS official FROM dated WHERE trim({sql_squeeze(sql_xml_safe('title'))}) <> ''"""))
def _(spark, sf):
    e = feeds.read_feeds(feed_payloads(spark, sf))
    return e.select("source_id", "guid", "title", "url", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"), "doi", "canonical_url", "description", "official")


@query("sc3_read_news_feeds", with_sql(DATED, f"""
    , e AS (SELECT doc_id, source, lang, ts, {sql_squeeze(sql_xml_safe('title'))} AS title, length({sql_squeeze(sql_xml_safe('text'))}) AS n_body,
       {sql_squeeze(sql_xml_safe('text'))} AS body, 'https://' || lang || '.example.com/a/' || doc_id || '?utm_source=feed#x' AS url FROM dated),
    f AS (SELECT *, CASE WHEN lang = 'en' THEN regexp_replace(title, '\\s+-\\s+[^-]+$', '') ELSE title END AS short FROM e WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-02' AND NOT regexp_matches(body, 'members only|log in/register', 'i')),
    r AS (SELECT *, row_number() OVER (PARTITION BY source, lang, doc_id // 100 ORDER BY doc_id) AS rn FROM f WHERE short <> '')
    SELECT substr(md5(url), 1, 10) AS id, source AS source_id, CASE WHEN lang = 'en' THEN 'Paper ' || source ELSE upper(source) END AS source_label, short AS title, url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS published, n_body FROM r WHERE rn <= 2"""))
def _(spark, sf):
    p = feed_payloads(spark, sf).withColumns({"max_age_days": F.lit(2), "max_items": F.lit(2)})
    e = feeds.read_news_feeds(p, F.lit("2024-01-04").cast("timestamp"))
    return e.select("id", "source_id", "source_label", "title", "url", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"), F.length("body").alias("n_body"))


@query("sc4_read_papers", with_sql(DATED, f"""
    , p AS (SELECT doc_id, source, ts, {sql_squeeze(sql_xml_safe('title'))} AS title, 'Aim: ' || {sql_squeeze(sql_xml_safe('text'))} || chr(10) || 'n=5' AS abstract FROM dated)
    SELECT doc_id::VARCHAR AS pmid, title, upper(source) AS journal, abstract, '10.99/' || doc_id AS doi, strftime(ts, '%Y-%m-') || lpad(least(28, day(ts))::VARCHAR, 2, '0') AS published FROM p WHERE length(abstract) > 150 AND title <> ''"""))
def _(spark, sf):
    d = dated(spark, sf)
    title, body = squeeze(xml_safe(F.col("title"))), squeeze(xml_safe(F.col("text")))
    xml = F.concat(
        F.lit("<PubmedArticle><MedlineCitation><PMID Version=\"1\">"), F.col("doc_id").cast("string"), F.lit("</PMID><Article><Journal><Title>"), F.upper("source"),
        F.lit("</Title><JournalIssue><PubDate><Year>"), F.date_format("ts", "yyyy"), F.lit("</Year><Month>"), F.date_format("ts", "MMM"), F.lit("</Month><Day>"), F.date_format("ts", "d"),
        F.lit("</Day></PubDate></JournalIssue></Journal><ArticleTitle>"), title, F.lit("</ArticleTitle><Abstract><AbstractText Label=\"Aim\">"), body,
        F.lit("</AbstractText><AbstractText>n=5</AbstractText></Abstract></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType=\"pubmed\">1</ArticleId><ArticleId IdType=\"doi\">10.99/"),
        F.col("doc_id").cast("string"), F.lit("</ArticleId></ArticleIdList></PubmedData></PubmedArticle>"),
    )
    return papers.parse_papers(d.select(xml.alias("xml"))).select("pmid", "title", "journal", "abstract", "doi", F.date_format("published_on", "yyyy-MM-dd").alias("published"))


@query("sc5_read_social", """
    SELECT event_id::VARCHAR AS id, 'r/' || event_type AS source_label, CAST(floor(value) AS BIGINT) AS score, user_id AS num_comments, strftime(ts, '%Y-%m-%d %H:%M:%S') AS published, event_type = 'error' AS over18 FROM events""")
def _(spark, sf):
    e = table(spark, sf, "events")
    post = F.struct(F.struct(
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("subreddit"), F.lit("t").alias("title"), F.col("props").alias("selftext"), F.lit("/p").alias("permalink"),
        F.floor("value").cast("long").alias("score"), F.col("user_id").alias("num_comments"), F.unix_seconds("ts").alias("created_utc"), (F.col("event_type") == "error").alias("over_18"), F.lit(False).alias("stickied"), F.lit(True).alias("is_self"),
    ).alias("data"))
    pages = e.groupBy("event_type", F.floor(F.col("event_id") / 250).alias("page")).agg(F.collect_list(post).alias("children"))
    payload = pages.select(F.to_json(F.struct(F.struct("children").alias("data"))).alias("json"))
    return records.read_social(payload).select("id", "source_label", "score", "num_comments", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"), "over18")


@query("sc6_read_event_log", "SELECT event_id::VARCHAR AS articleId, event_type AS newStatus, user_id::VARCHAR AS reviewerRole FROM events WHERE value <= 90")
def _(spark, sf):
    e = table(spark, sf, "events")
    line = F.to_json(F.struct(F.col("event_id").cast("string").alias("articleId"), F.col("event_type").alias("newStatus"), F.col("user_id").cast("string").alias("reviewerRole")))
    lines = e.select(F.when(F.col("value") > 90, F.substring(line, 1, 20)).otherwise(line).alias("value"))
    return records.parse_event_lines(lines).select("articleId", "newStatus", "reviewerRole")


@query("sc1_read_editions", """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderkey::VARCHAR AS item_key, o_orderpriority AS category FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""")
def _(spark, sf):
    """Edition files of at most a thousand ids per day; pending orders are drafts, low ones are scheduled for later."""
    o = table(spark, sf, "orders")
    item = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("category"), F.when(F.col("o_orderpriority") == "5-LOW", "2024-02-01T00:00:00Z").alias("scheduledAt"))
    name = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderstatus") == "P", ".draft.json").otherwise(".json"))
    files = o.groupBy(name.alias("file"), F.floor(F.col("o_orderkey") / 1000).alias("block")).agg(F.collect_list(item).alias("items"))
    payload = files.select("file", F.to_json(F.struct(F.lit("published").alias("status"), "items")).alias("json"))
    return records.parse_editions(payload, now()).select("date", "item_key", F.col("item.category").alias("category"))


@query("sc7_read_performance", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS DOUBLE) AS impressions, CAST(l_linenumber AS DOUBLE) AS clicks, CASE WHEN l_discount * 100 > 1 THEN l_discount * 100 / 100 ELSE l_discount * 100 END AS ctr, 'a' || l_partkey AS article_id FROM lineitem""")
def _(spark, sf):
    raw = table(spark, sf, "lineitem").select(
        F.concat_ws("/", F.lit("https://e.example.com/article"), F.concat(F.lit("a"), "l_partkey")).alias("페이지"), F.format_number("l_quantity", 0).alias("노출수"), F.col("l_linenumber").cast("string").alias("클릭수"),
        F.concat((F.col("l_discount") * 100).cast("string"), F.lit("%")).alias("CTR"), F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey").alias("query"),
    )
    p = records.normalize_performance(raw, "gsc")
    key = F.split("query", r"\|")
    return p.select(key[0].cast("long").alias("l_orderkey"), key[1].cast("int").alias("l_linenumber"), key[2].cast("long").alias("l_partkey"), "impressions", "clicks", "ctr", "article_id")


@query("sc8_read_keywords", """
    SELECT p_brand AS file, p_name || ', ' || p_partkey AS keyword, CASE WHEN p_size < 10 THEN 5.0 ELSE p_size END + 1000.0 + p_partkey AS volume, p_type AS competition FROM part""")
def _(spark, sf):
    """A keyword export per brand: two notes, a two-row header, then one line per part."""
    p = table(spark, sf, "part")
    line = F.concat(F.lit('"'), "p_name", F.lit(", "), F.col("p_partkey").cast("string"), F.lit('",'), F.when(F.col("p_size") < 10, F.lit("< 10")).otherwise(F.col("p_size").cast("string")), F.lit(',"'),
                    F.format_number(F.col("p_partkey") + 1000, 0), F.lit('",'), "p_type")
    body = p.select(F.col("p_brand").alias("file"), (F.col("p_partkey") + 10).alias("line_no"), line.alias("line"))
    notes = [(0, "tool export"), (1, ""), (2, "연관키워드,월간검색수,,경쟁정도"), (3, ",월간검색수(PC),월간검색수(모바일),")]
    head = p.select(F.col("p_brand").alias("file")).distinct().select("file", F.explode(F.array(*[F.struct(F.lit(n).cast("long").alias("line_no"), F.lit(t).alias("line")) for n, t in notes])).alias("n")).select("file", "n.line_no", "n.line")
    return records.parse_keyword_lines(body.unionByName(head)).select("file", "keyword", "volume", "competition")


@query("sc9_read_pages", "SELECT regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS lang, count(*) AS n_pages, CAST(sum(length(html)) AS BIGINT) AS n_chars FROM pages GROUP BY 1")
def _(spark, sf):
    p = records.read_pages(spark, f"{sf}/pages.parquet")
    return p.groupBy(F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang")).agg(F.count("*").alias("n_pages"), F.sum(F.length("html")).cast("long").alias("n_chars"))


@query("sc10_read_sitemap", "SELECT CAST(page_id // 100 AS BIGINT) AS part, url AS loc FROM pages")
def _(spark, sf):
    entry = F.concat(F.lit("<url><loc>"), "url", F.lit("</loc></url>"))
    maps = table(spark, sf, "pages").groupBy(F.floor(F.col("page_id") / 100).alias("part")).agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(entry), ""), F.lit("</urlset>")).alias("xml"))
    return feeds.read_sitemap(maps)


@query("sc11_normalize_registry", """
    SELECT s_suppkey, 'src-' || regexp_replace(regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS id, 'supplier' || s_suppkey || '.example.com' AS domain, s_acctbal > 0 AS enabled,
      greatest(250, CAST(s_suppkey * 10 AS INTEGER) + CASE WHEN s_suppkey = 0 THEN 1000 ELSE 0 END) AS rate_limit_ms, least(60000, greatest(3000, CAST(s_suppkey * 1000 AS INTEGER) + CASE WHEN s_suppkey = 0 THEN 12000 ELSE 0 END)) AS timeout_ms,
      CASE WHEN s_acctbal > 0 THEN 50 ELSE 0 END AS priority, CASE WHEN s_acctbal > 0 THEN 'unknown' ELSE 'disabled' END AS health_status FROM supplier""")
def _(spark, sf):
    none = F.array().cast("array<string>")
    raw = table(spark, sf, "supplier").select(
        "s_suppkey", F.lit("").alias("id"), F.concat(F.lit("  "), "s_name").alias("label"), F.array(F.concat(F.lit("https://www.Supplier"), "s_suppkey", F.lit(".example.com/x")), F.lit("")).alias("domains"),
        F.when(F.col("s_acctbal") > 0, F.array(F.lit("https://f/1"))).otherwise(none).alias("rss_urls"), none.alias("atom_urls"), F.lit(None).cast("boolean").alias("enabled"),
        (F.col("s_suppkey") * 10).cast("int").alias("rate_limit_ms"), (F.col("s_suppkey") * 1000).cast("int").alias("timeout_ms"), F.lit(None).cast("int").alias("priority"),
        F.lit(None).cast("int").alias("consecutive_failures"), F.lit("").alias("health_status"),
    )
    r = registry.normalize_registry(raw)
    return r.select("s_suppkey", "id", F.get("domains", F.lit(0)).alias("domain"), "enabled", "rate_limit_ms", "timeout_ms", "priority", "health_status")


@query("sc12_build_registry", with_sql(ITEMS, f"""
    , h AS (SELECT DISTINCT source_label AS label, {sql_host('source_url')} AS domain FROM items), c AS (SELECT DISTINCT source_label AS label, source_label || '.org' AS domain FROM items WHERE lang = 'es' UNION SELECT 'unused', NULL),
    a AS (SELECT label, domain, FALSE AS configured FROM h UNION ALL SELECT label, domain, TRUE FROM c)
    SELECT label, domain, bool_or(configured) AS configured, label <> 'unused' AS enabled FROM a GROUP BY ALL"""))
def _(spark, sf):
    i = items(spark, sf)
    mapping = i.where("lang = 'es'").select(F.col("source_label").alias("label"), F.array(F.concat("source_label", F.lit(".org"))).alias("domains")).distinct()
    unused = table(spark, sf, "region").where("r_regionkey = 0").select(F.lit("unused").alias("label"), F.array().cast("array<string>").alias("domains"))
    return registry.build_registry(i, mapping.unionByName(unused)).select("label", "domain", "configured", "enabled")


def editions(spark, sf):
    i = items(spark, sf).select("doc_id", "date", "quality", "lang", "source_url", F.array("source_url").alias("keys"))
    return i.where("quality = 1"), i.where("quality IS NULL OR quality <> 1")


@query("sk1_merge_edition", with_sql(ITEMS, """
    SELECT doc_id, strftime(date, '%Y-%m-%d') AS date FROM items i WHERE quality = 1 OR NOT EXISTS (SELECT 1 FROM items e WHERE e.quality = 1 AND e.date = i.date AND e.source_url = i.source_url)"""))
def _(spark, sf):
    old, new = editions(spark, sf)
    return sinks.merge_edition(old, new, "date", "doc_id", "keys").select("doc_id", F.date_format("date", "yyyy-MM-dd").alias("date"))


@query("sk2_upsert_by_id", """
    WITH n AS (SELECT l_orderkey AS o_orderkey, l_extendedprice AS o_totalprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem WHERE l_returnflag = 'R')
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n) UNION ALL SELECT o_orderkey, o_totalprice FROM n WHERE rn = 1""")
def _(spark, sf):
    old = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    new = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("o_totalprice"), "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")
    order = [F.col(c).desc() for c in ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "o_totalprice")]
    return sinks.upsert(old, new, ["o_orderkey"], order).select("o_orderkey", "o_totalprice")


@query("sk3_search_manifest", with_sql(ITEMS, """
    SELECT strftime(date, '%Y-%m') AS month, count(*) AS n_entries, CAST(sum(strlen('{"doc_id":' || doc_id || ',"lang":"' || lang || '","source_url":"' || source_url || '"}')) AS BIGINT) AS n_bytes FROM items GROUP BY 1"""))
def _(spark, sf):
    i = items(spark, sf).withColumn("month", F.date_format("date", "yyyy-MM"))
    return sinks.search_manifest(i, "month", ["doc_id", "lang", "source_url"])


@query("sk4_audit_events", """
    SELECT '{"articleId":"' || event_id || '","previousStatus":"draft","newStatus":"' || event_type || '","reviewedAt":"' || strftime(ts, '%Y-%m-%d') || '"}' AS line FROM events""")
def _(spark, sf):
    """The lines that append_events stores for state changes."""
    e = table(spark, sf, "events")
    row = F.struct(F.col("event_id").cast("string").alias("articleId"), F.lit("draft").alias("previousStatus"), F.col("event_type").alias("newStatus"), F.date_format("ts", "yyyy-MM-dd").alias("reviewedAt"))
    return e.select(F.to_json(row).alias("line"))


@query("sk5_bounded_history", """
    WITH r AS (SELECT *, strftime(ts, '%Y-%m-%d %H') AS run FROM events), l AS (SELECT DISTINCT run FROM r ORDER BY run DESC LIMIT 30) SELECT event_id, run FROM r WHERE run IN (SELECT run FROM l)""")
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("run", F.date_format("ts", "yyyy-MM-dd HH"))
    newest = F.col("ts") >= F.lit("2024-01-30").cast("timestamp")
    return sinks.bounded_history(e.where(~newest), e.where(newest), "run", 30).select("event_id", "run")


@query("sk6_bounded_seen", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 20000")
def _(spark, sf):
    order = [F.col("l_shipdate").desc()] + [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    return sinks.bounded_seen(table(spark, sf, "lineitem"), F.to_date("l_shipdate"), order, 20_000).select("l_orderkey", "l_linenumber", "l_partkey")


@query("sk7_upsert_decisions", """
    WITH n AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events WHERE event_type IN ('view', 'click')),
    o AS (SELECT user_id, 'pending' AS event_type FROM events GROUP BY user_id) SELECT user_id, event_type FROM o WHERE user_id NOT IN (SELECT user_id FROM n) UNION ALL SELECT user_id, event_type FROM n WHERE rn = 1""")
def _(spark, sf):
    e = table(spark, sf, "events")
    old = e.select("user_id").distinct().withColumn("event_type", F.lit("pending"))
    new = e.where("event_type IN ('view', 'click')").select("user_id", "event_type", "event_id")
    return sinks.upsert(old, new, ["user_id"], [F.col("event_id").desc()]).select("user_id", "event_type")


@query("sk8_latest_edition", with_sql(ITEMS_Q, "SELECT doc_id, strftime(date, '%Y-%m-%d') AS date FROM iq WHERE renderable AND date = (SELECT max(date) FROM iq)"))
def _(spark, sf):
    shown = R.card_renderable(R.quality_issues())
    return sinks.latest_edition(items(spark, sf), "date", shown).select("doc_id", F.date_format("date", "yyyy-MM-dd").alias("date"))


@query("sk9_publish_blockers", with_sql(ITEMS_Q, f"""
    SELECT doc_id, workflow_status <> 'approved' AS not_approved, len(publish_codes) > 0 AS quality_blocked, scheduled_at IS NOT NULL AND scheduled_at > TIMESTAMP '{NOW}' AS later,
      title = '' OR lead = '' OR len(paragraphs) = 0 OR content_tier IS NULL OR clinical_risk IS NULL AS contract_blocked FROM iq"""))
def _(spark, sf):
    b = sinks.publish_blockers(items(spark, sf), R.contract_issues(), R.publish_issues(), now())
    has = lambda p: F.exists("reasons", lambda r: F.startswith(r, F.lit(p)))
    return b.select("doc_id", has("workflow-status:").alias("not_approved"), has("quality:").alias("quality_blocked"), has("scheduled").alias("later"), has("contract:").alias("contract_blocked"))


@query("sk10_bucket_by_day", with_sql(ITEMS, """
    , k AS (SELECT *, strftime(published_at + INTERVAL 9 HOUR, '%Y-%m-%d') AS day FROM items)
    SELECT doc_id, day FROM k n WHERE coalesce(quality, -1) <> 1 AND NOT EXISTS (SELECT 1 FROM k e WHERE e.quality = 1 AND e.day = n.day AND e.source_url = n.source_url)"""))
def _(spark, sf):
    i = items(spark, sf).select("doc_id", "published_at", "quality", F.array("source_url").alias("keys"))
    held = i.where("quality = 1").withColumn("day", F.to_date(F.from_utc_timestamp("published_at", "Asia/Seoul")))
    new = i.where("quality IS NULL OR quality <> 1")
    return sinks.bucket_by_day(new, held, "published_at", "doc_id", "keys").select("doc_id", F.date_format("day", "yyyy-MM-dd").alias("day"))


