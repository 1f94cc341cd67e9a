"""Queries for identity and normalisation (ID*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import RELAY_URL, UNSAFE_PATH, WS
from ..functions import dates, urls
from ..functions import text as tx
from ..functions.patterns import strip
from ..operators import joins as J
from ..operators import rules as R
from . import query
from .tables import (
    ART, ITEMS, NOW, articles, items, now, sql_host, sql_normal_url, sql_path, sql_squeeze, sql_strip, sql_url, table, with_sql,
)


@query("id1_normalize_url", f"SELECT page_id, {sql_normal_url('url')} AS normal_url FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.normalize_url(F.col("url")).alias("normal_url"))


@query("id2_source_keys", f"""
    WITH k AS (
      SELECT page_id, unnest([{sql_normal_url('url')}, {sql_normal_url("regexp_replace(url, '^http://', 'https://')")},
                              {sql_normal_url("split_part(url, '?', 1)")}]) AS source_key FROM pages)
    SELECT DISTINCT page_id, source_key FROM k WHERE source_key <> ''""")
def _(spark, sf):
    u = F.col("url")
    keys = urls.source_keys(u, F.regexp_replace(u, "^http://", "https://"), F.split_part(u, F.lit("?"), F.lit(1)))
    return table(spark, sf, "pages").select("page_id", F.explode(keys).alias("source_key"))


@query("id3_stable_item_id", f"SELECT page_id, 'v1_' || substr(sha256({sql_normal_url('url')}), 1, 16) AS item_id FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.stable_item_id([F.col("url")], [F.lit("item")]).alias("item_id"))


def sql_title_key(col: str) -> str:
    whole = f"regexp_replace(lower({col}), '[^a-z0-9가-힣]', '', 'g')"
    return f"(CASE WHEN length({whole}) <= 80 THEN {whole} ELSE substr({whole}, 1, 80) || '#' || substr(md5({whole}), 1, 16) END)"


def sql_short(slug: str, size: int) -> str:
    return f"(CASE WHEN length({slug}) <= {size} THEN {slug} ELSE regexp_replace(substr({slug}, 1, {size}), '-+$', '') || '-' || substr(md5({slug}), 1, 8) END)"


@query("id4_title_key", with_sql(ART, f"SELECT doc_id, {sql_title_key('title')} AS title_key FROM art"))
def _(spark, sf):
    return articles(spark, sf).select("doc_id", tx.title_key(F.col("title")).alias("title_key"))


SQL_TITLE = ("trim(regexp_replace(lower(regexp_replace(regexp_replace({c}, '<[^>]+>', ' ', 'g'), '&(?:amp|nbsp|quot|#39);', ' ', 'gi')), "
             "'[^a-z0-9가-힣]+', ' ', 'g'))")


def sql_title(col: str) -> str:
    return SQL_TITLE.replace("{c}", col)


@query("id5_normalize_title", with_sql(ART, f"SELECT doc_id, {sql_title('title')} AS normal_title FROM art"))
def _(spark, sf):
    return articles(spark, sf).select("doc_id", tx.normalize_title(F.col("title")).alias("normal_title"))


def sql_tokens(col: str) -> str:
    return f"list_distinct([w for w in string_split({sql_title(col)}, ' ') if length(w) > 1])"


@query("id6_title_tokens", with_sql(ART, f"SELECT doc_id, array_to_string(list_sort({sql_tokens('title')}), ' ') AS tokens, len({sql_tokens('title')}) AS n_tokens FROM art"))
def _(spark, sf):
    words = tx.title_tokens(F.col("title"))
    return articles(spark, sf).select("doc_id", F.array_join(F.array_sort(words), " ").alias("tokens"), F.size(words).alias("n_tokens"))


@query("id7_content_hash", with_sql(ITEMS, "SELECT doc_id, sha256(CAST(to_json(struct_pack(title := title, lead := lead, body := paragraphs, angle := '')) AS VARCHAR)) AS content_hash FROM items"))
def _(spark, sf):
    return items(spark, sf).select("doc_id", _content_hash().alias("content_hash"))


def _content_hash():
    return tx.struct_hash(title=F.col("title"), lead=F.col("lead"), body_=F.col("paragraphs"), key_points_=F.col("key_points"), angle=F.col("angle"))


@query("id8_source_hash", with_sql(ITEMS, """
    SELECT doc_id, sha256(CAST(to_json(struct_pack(source_url := source_url, source_url_raw := '', source_title := '', source_label := source_label,
      published_at := regexp_replace(strftime(published_at, '%Y-%m-%d %H:%M:%S.%f'), '\\.?0+$', ''), doi := '')) AS VARCHAR)) AS source_hash FROM items"""))
def _(spark, sf):
    return items(spark, sf).select(
        "doc_id",
        tx.struct_hash(source_url=F.col("source_url"), source_url_raw=F.col("source_url_raw"), source_title=F.col("source_title"),
                       source_label=F.col("source_label"), published_at=F.col("published_at").cast("string"), doi=F.col("doi")).alias("source_hash"),
    )


@query("id9_text_hash", "SELECT doc_id, sha256(text) AS text_hash, sha256(lang || '|' || source) AS metadata_hash FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tx.text_hash(F.col("text")).alias("text_hash"), tx.text_hash(F.concat_ws("|", "lang", "source")).alias("metadata_hash")
    )


@query("id10_host_of", f"SELECT page_id, {sql_host('url')} AS host FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.host_of(F.col("url")).alias("host"))


@query("id11_is_relay", f"""
    SELECT page_id, regexp_matches(url, '{RELAY_URL.replace("(?i)", "")}', 'i') AS as_is,
           regexp_matches('https://news.google.com/rss/articles/' || page_id, '{RELAY_URL.replace("(?i)", "")}', 'i') AS as_relay FROM pages""")
def _(spark, sf):
    relay = F.concat(F.lit("https://news.google.com/rss/articles/"), F.col("page_id"))
    return table(spark, sf, "pages").select("page_id", urls.is_relay(F.col("url")).alias("as_is"), urls.is_relay(relay).alias("as_relay"))


def sql_safe(col: str) -> str:
    full_host = f"regexp_replace(lower({sql_url(sql_strip(col), 2)}), '^[^@]*@|:\\d*$', '', 'g')"
    return (f"(lower({sql_url(sql_strip(col), 1)}) = 'https' AND NOT regexp_matches({col}, '{RELAY_URL.replace('(?i)', '')}', 'i') "
            f"AND NOT regexp_matches({full_host} || {sql_path(col)}, '{UNSAFE_PATH.replace('(?i)', '')}', 'i'))")


@query("id12_is_safe_article_url", f"SELECT page_id, {sql_safe('url')} AS safe, {sql_safe("(url || '/login')")} AS safe_login FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", urls.is_safe_article_url(F.col("url")).alias("safe"), urls.is_safe_article_url(F.concat("url", F.lit("/login"))).alias("safe_login")
    )


def registry_domains(spark, sf):
    """Registry: the domains of the pages, with example.org left out as the unofficial one."""
    host = urls.host_of(F.col("url"))
    return table(spark, sf, "pages").select(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain")).where("domain <> ''").distinct().where(F.col("domain") != "example.org")


@query("id13_is_official", f"SELECT page_id, regexp_matches({sql_host('url')}, '(^|\\.)(example\\.com|example\\.net)$') AS official FROM pages")
def _(spark, sf):
    hit = J.match_domain(table(spark, sf, "pages"), "url", registry_domains(spark, sf), "domain", "page_id")
    return hit.select("page_id", F.col("domain").isNotNull().alias("official"))


@query("id14_normalize_doi", """
    WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'doi: 10.1234/' || source || '.' || doc_id || '.' WHEN doc_id % 3 = 1
      THEN 'https://doi.org/10.5555/' || lang || '/' || doc_id ELSE source END AS raw FROM documents),
    b AS (SELECT doc_id, regexp_replace(regexp_replace(raw, '^doi:\\s*', '', 'i'), '^https?://(?:dx\\.)?doi\\.org/', '', 'i') AS bare FROM d)
    SELECT doc_id, CASE WHEN regexp_matches(bare, '^10\\.\\d{4,9}/\\S+$') THEN regexp_replace(bare, '[.,;)]+$', '') END AS doi FROM b""")
def _(spark, sf):
    n = F.col("doc_id")
    raw = (
        F.when(n % 3 == 0, F.concat(F.lit("doi: 10.1234/"), "source", F.lit("."), n, F.lit(".")))
        .when(n % 3 == 1, F.concat(F.lit("https://doi.org/10.5555/"), "lang", F.lit("/"), n)).otherwise(F.col("source"))
    )
    return table(spark, sf, "documents").select("doc_id", urls.normalize_doi(raw).alias("doi"))


SQL_SOURCE_SLUG = "regexp_replace(regexp_replace(lower(s_name || repeat(' long name', s_suppkey % 9)), '[^a-z0-9가-힣]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query("id15_source_id", f"""
    SELECT s_suppkey, 'src-' || {sql_short(SQL_SOURCE_SLUG, 56)} AS source_id, 'src-abc-1' AS folded_id,
      'src-' || substr(sha1('★'), 1, 10) AS fallback_id FROM supplier""")
def _(spark, sf):
    name = F.concat("s_name", F.expr("repeat(' long name', cast(s_suppkey % 9 as int))"))  # some are longer than a slug
    return table(spark, sf, "supplier").select("s_suppkey", urls.source_id(name).alias("source_id"), urls.source_id(F.lit("ＡＢＣ ①")).alias("folded_id"), urls.source_id(F.lit("★")).alias("fallback_id"))


@query("id16_article_slug", with_sql(ART, f"""
    , w AS (SELECT *, regexp_replace(regexp_replace({sql_strip(f"regexp_replace(title, '[^가-힣a-zA-Z0-9{WS}]', '', 'g')")}, '[{WS}]+', '-', 'g'), '-+$', '') AS slug FROM art),
    s AS (SELECT * EXCLUDE (slug), {sql_short('slug', 40)} AS words FROM w)
    SELECT doc_id, CASE WHEN lang = 'es' THEN 'old-' || doc_id WHEN lang = 'de' THEN 'v1_' || substr(sha256(text), 1, 16)
      WHEN words <> '' THEN doc_id || '-' || words ELSE doc_id::VARCHAR END AS slug FROM s"""))
def _(spark, sf):
    legacy = F.when(F.col("lang") == "es", F.concat(F.lit("old-"), "doc_id"))
    item = F.when(F.col("lang") == "de", F.concat(F.lit("v1_"), F.substring(F.sha2("text", 256), 1, 16))).otherwise(F.col("doc_id").cast("string"))
    return articles(spark, sf).select("doc_id", urls.article_slug(item, F.col("title"), legacy).alias("slug"))


@query("id17_clean_image_url", f"""
    WITH i AS (SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN '/img/a' || page_id || '.jpg' WHEN 1 THEN 'http://cdn.example.com/x.png'
        WHEN 2 THEN '/img/logo.png' ELSE '//m.example.net/y.webp' END AS raw FROM pages),
    r AS (SELECT page_id, CASE WHEN raw LIKE 'http%' THEN raw WHEN raw LIKE '//%' THEN lower({sql_url('url', 1)}) || ':' || raw
        ELSE lower({sql_url('url', 1)}) || '://' || lower({sql_url('url', 2)}) || raw END AS full_url FROM i)
    SELECT page_id, CASE WHEN full_url LIKE '%logo%' THEN NULL ELSE regexp_replace(full_url, '^http:', 'https:') END AS image_url FROM r""")
def _(spark, sf):
    n = F.col("page_id") % 4
    raw = F.when(n == 0, F.concat(F.lit("/img/a"), "page_id", F.lit(".jpg"))).when(n == 1, "http://cdn.example.com/x.png").when(n == 2, "/img/logo.png").otherwise("//m.example.net/y.webp")
    return table(spark, sf, "pages").select("page_id", urls.clean_image_url(raw, F.col("url")).alias("image_url"))


@query("id18_image_key", "SELECT page_id, lower(regexp_replace(url, '[?#].*$', '')) AS image_key FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.image_key(F.col("url")).alias("image_key"))


@query("id19_site_publication_date", """
    SELECT o_orderkey, strftime(coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END,
       CASE WHEN o_orderstatus = 'O' THEN o_orderdate END, TIMESTAMP '1995-01-01'), '%Y-%m-%d') AS published FROM orders""")
def _(spark, sf):
    day = F.col("o_orderdate")
    out = dates.site_publication_date(
        F.when(F.col("o_orderstatus") == "F", day + F.expr("INTERVAL 1 DAY")), F.when(F.col("o_orderstatus") == "O", day), F.lit("1995-01-01").cast("timestamp")
    )
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(out, "yyyy-MM-dd").alias("published"))


@query("id20_clamp_published", """
    SELECT o_orderkey, strftime(CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '1998-01-01' ELSE least(o_orderdate, TIMESTAMP '1998-01-01') END, '%Y-%m-%d') AS shown FROM orders""")
def _(spark, sf):
    source = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(dates.clamp_published(source, F.lit("1998-01-01").cast("timestamp")), "yyyy-MM-dd").alias("shown"))


@query("id21_kst_calendar", """
    SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS kst_day, CAST(extract(hour FROM ts + INTERVAL 9 HOUR) AS INTEGER) AS kst_hour,
      CASE WHEN event_type = 'error' THEN NULL ELSE CAST(DATE '2024-01-31' - CAST(ts + INTERVAL 9 HOUR AS DATE) AS INTEGER) END AS age FROM events""")
def _(spark, sf):
    day = F.date_format(dates.kst_date(F.col("ts")), "yyyy-MM-dd")
    label = F.when(F.col("event_type") == "error", "2024-13-45").otherwise(day)
    return table(spark, sf, "events").select(
        "event_id", day.alias("kst_day"), dates.kst_hour(F.col("ts")).alias("kst_hour"), dates.calendar_age(label, F.lit("2024-01-31")).alias("age")
    )


@query("id22_iso_week", "SELECT o_orderkey, strftime(o_orderdate, '%G-W%V') AS week FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", dates.iso_week(F.col("o_orderdate")).alias("week"))


SQL_DECK = """CASE WHEN length(flat) <= 220 THEN flat
    WHEN length(regexp_extract(substr(flat, 1, 220), '^((?s:.*)[.!?])', 1)) - 1 > 80 THEN regexp_extract(substr(flat, 1, 220), '^((?s:.*)[.!?])', 1)
    ELSE trim(substr(flat, 1, 220)) || '…' END"""


@query("id23_to_article", with_sql(ITEMS, f"""
    , f AS (SELECT *, {sql_squeeze("CASE WHEN lead <> '' THEN lead ELSE coalesce(paragraphs[1], '') END")} AS flat FROM items),
    g AS (SELECT *, {SQL_DECK} AS deck FROM f)
    SELECT doc_id, title, deck, source_label AS source, greatest(1, CAST(floor((length(title) + length(deck) + length(array_to_string(paragraphs, ''))) / 500.0 + 0.5) AS INTEGER)) AS read_minutes,
      strftime(least(published_at, TIMESTAMP '{NOW}') + INTERVAL 9 HOUR, '%Y.%m.%d') AS shown_date,
      '/article/' || doc_id AS href FROM g"""))
def _(spark, sf):
    i = items(spark, sf)
    lead = F.when(F.col("lead") != "", F.col("lead")).otherwise(F.try_element_at("paragraphs", F.lit(1)))
    i = i.withColumn("deck", tx.trim_deck(lead))
    chars = F.length("title") + F.length("deck") + F.length(F.array_join("paragraphs", ""))
    return i.select(
        "doc_id", "title", "deck", tx.short_source(F.col("source_label")).alias("source"),
        F.greatest(F.lit(1), F.floor(chars / 500 + 0.5).cast("int")).alias("read_minutes"),
        F.date_format(dates.kst_date(dates.clamp_published(F.col("published_at"), now())), "yyyy.MM.dd").alias("shown_date"),
        F.concat(F.lit("/article/"), "id").alias("href"),
    )


@query("id24_compact_article", with_sql(ITEMS, "SELECT doc_id, title, lead AS deck, category, strftime(date, '%Y-%m-%d') AS day, source_url FROM items"))
def _(spark, sf):
    return items(spark, sf).select("doc_id", "title", F.col("lead").alias("deck"), "category", F.date_format("date", "yyyy-MM-dd").alias("day"), "source_url")


@query("id25_evidence_metadata", with_sql(ITEMS, """
    SELECT doc_id, array_to_string(list_filter(['studyType=' || nullif(trim(coalesce(event_type, '')), ''), 'speciesStudied=' || lang,
       'sampleSize=' || CASE WHEN n_chars > 1000 THEN n_chars END, 'journal=' || CASE WHEN quality = 1 THEN source_label END], lambda x: x IS NOT NULL), ';') AS evidence FROM items"""))
def _(spark, sf):
    values = {
        "studyType": F.col("event_type"), "speciesStudied": F.col("lang"), "sampleSize": F.when(F.col("n_chars") > 1000, F.col("n_chars")).cast("string"),
        "journal": F.when(F.col("quality") == 1, F.col("source_label")), "limitations": F.lit("  "),
    }
    kept = evidence_metadata(values)
    return items(spark, sf).select("doc_id", F.array_join(F.transform(F.map_entries(kept), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("evidence"))


def evidence_metadata(values):
    pairs = [x for k, v in values.items() for x in (F.lit(k), v)]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull() & (strip(v) != ""))


@query("id26_with_identity", with_sql(ITEMS, """
    SELECT doc_id, 'v1_' || substr(sha256(source_url), 1, 16) AS item_id, workflow_status, coalesce(content_tier, 'brief') AS content_tier, 64 AS hash_length FROM items"""))
def _(spark, sf):
    i = items(spark, sf).withColumns({"item_id": urls.stable_item_id([F.col("source_url")], [F.col("title")]), "content_hash": _content_hash()})
    return i.select(
        "doc_id", "item_id", R.workflow_status().alias("workflow_status"), R.content_tier().alias("content_tier"), F.length("content_hash").alias("hash_length")
    )


@query("id_pages_per_host", f"""
    WITH p AS (SELECT page_id, {sql_normal_url('url')} AS u, {sql_host('url')} AS host, {sql_strip("regexp_extract(html, '<title>((?s:.*?))</title>', 1, 'i')")} AS title FROM pages),
    f AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY page_id) AS rn FROM p)
    SELECT host, count(*) AS n_pages, count(DISTINCT title) AS n_titles FROM f WHERE rn = 1 GROUP BY host""")
def _(spark, sf):
    from ..functions import html
    from ..operators.dedup import first_per_key

    pages = table(spark, sf, "pages").select(
        "page_id", urls.normalize_url(F.col("url")).alias("normal_url"), urls.host_of(F.col("url")).alias("host"), html.page_title(F.col("html")).alias("title")
    )
    one_each = first_per_key(pages, ["normal_url"], [F.col("page_id")])
    return one_each.groupBy("host").agg(F.count("*").alias("n_pages"), F.countDistinct("title").alias("n_titles"))
