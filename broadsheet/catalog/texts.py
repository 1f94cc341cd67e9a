"""Queries for text and HTML jobs (TX*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import BIBLIOGRAPHIC_MARKERS, NARRATIVE, NUMBER_TOKEN, WS
from ..functions import html as H
from ..functions import text as tx
from ..functions.patterns import count
from ..operators.pages import with_meta
from . import query
from .identity import sql_title
from .tables import ART, DATED, articles, sql_path, sql_squeeze, sql_strip, sql_url, table, with_sql


def re2(pattern: str) -> str:
    """The pattern for DuckDB: white space as the rules understand it."""
    return pattern.replace(r"[\s", f"[{WS}").replace(r"\s", f"[{WS}]").replace("'", "''")


def sql_strip_html(expr: str) -> str:
    out = f"regexp_replace({expr}, '<script(?s:.*?)</script>', '', 'gi')"
    out = f"regexp_replace({out}, '<style(?s:.*?)</style>', '', 'gi')"
    out = f"regexp_replace({out}, '<[^>]+>', ' ', 'g')"
    for entity, plain in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#8217;|&rsquo;", "''"),
                          ("&#8220;|&#8221;|&ldquo;|&rdquo;", '"'), (r"&#\d+;", " ")):
        out = f"regexp_replace({out}, '{entity}', '{plain}', 'g')"
    return sql_squeeze(out)


@query("tx1_strip_html", f"SELECT page_id, {sql_strip_html('html')} AS visible_text FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.strip_html(F.col("html")).alias("visible_text"))


@query("tx2_clean_text", f"""
    WITH t AS (SELECT page_id, regexp_extract(html, '<title>((?s:.*?))</title>', 1, 'i') AS title FROM pages)
    SELECT page_id, {sql_squeeze("replace(regexp_replace(regexp_replace(title, '<[^>]+>', ' ', 'g'), '&amp;', '&', 'gi'), chr(0), '') || ' €A'")} AS clean FROM t""")
def _(spark, sf):
    title = F.regexp_extract("html", r"(?i)<title>([\s\S]*?)</title>", 1)
    return table(spark, sf, "pages").select("page_id", tx.clean_text(F.concat(title, F.lit("&nbsp;&#8364;&#x41;"))).alias("clean"))


def sql_paras(scope: str) -> str:
    return f"list_filter(list_transform(regexp_extract_all({scope}, '<p[^>]*>((?s:.*?))</p>', 1, 'i'), lambda x: {sql_strip_html('x')}), lambda x: length(x) > 60)"


@query("tx3_extract_body", f"""
    WITH s AS (SELECT page_id, {sql_paras("regexp_extract(html, '<article[^>]*>((?s:.*?))</article>', 1, 'i')")} AS a,
                      {sql_paras("regexp_extract(html, '<main[^>]*>((?s:.*?))</main>', 1, 'i')")} AS m, {sql_paras('html')} AS w FROM pages),
    n AS (SELECT page_id, a, m, w, length(array_to_string(a, '')) AS na, length(array_to_string(m, '')) AS nm, length(array_to_string(w, '')) AS nw FROM s),
    c AS (SELECT page_id, CASE WHEN na >= 800 THEN a WHEN nm >= 800 THEN m WHEN nw >= 800 THEN w
            WHEN na >= nm AND na >= nw THEN a WHEN nm >= nw THEN m ELSE w END AS parts FROM n)
    SELECT page_id, CASE WHEN length(array_to_string(parts, chr(10))) > 400 THEN array_to_string(parts, chr(10)) END AS body FROM c""")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.extract_body(F.col("html")).alias("body"))


@query("tx4_extract_lead_image", f"""
    SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://cdn.example.com/p' || page_id || '.jpg' WHEN 1 THEN 'https://' || lower({sql_url('url', 2)}) || '/t/' || page_id || '.png' END AS lead_image FROM pages""")
def _(spark, sf):
    # The pages carry no image tags, so a head with known ones is put in front of the page.
    n = F.col("page_id")
    head = (
        F.when(n % 3 == 0, F.concat(F.lit('<meta content="/img/logo.png" property="og:image"><meta name="twitter:image" content="http://cdn.example.com/p'), n, F.lit('.jpg">')))
        .when(n % 3 == 1, F.concat(F.lit('<link href="/t/'), n, F.lit('.png" rel="image_src">'))).otherwise(F.lit(""))
    )
    return table(spark, sf, "pages").select("page_id", H.lead_image(F.concat(head, "html"), F.col("url")).alias("lead_image"))


SQL_PAGE_TITLE = sql_strip("regexp_extract(html, '<title>((?s:.*?))</title>', 1, 'i')")


@query("tx5_extract_page_meta", f"SELECT page_id, {SQL_PAGE_TITLE} AS title, '' AS description, '' AS canonical, '' AS robots, '' AS og_url FROM pages")
def _(spark, sf):
    return with_meta(table(spark, sf, "pages")).select("page_id", "title", "description", "canonical", "robots", "og_url")


@query("tx6_extract_jsonld", "SELECT page_id, 'NewsArticle' AS types, 1 AS errors FROM pages")
def _(spark, sf):
    n = F.col("page_id")
    block = F.concat(F.lit('<script type="application/ld+json">{"@graph":[{"@type":["NewsArticle"],"headline":"h'), n, F.lit('"}]}</script><script type="application/ld+json">{broken</script>'))
    doc = F.concat(block, "html")
    return table(spark, sf, "pages").select("page_id", F.array_join(H.jsonld_types(doc), ",").alias("types"), H.jsonld_errors(doc).alias("errors"))


@query("tx7_page_kind", f"""
    WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/article' || {sql_path('url')} WHEN 1 THEN '/topic/' || page_id WHEN 2 THEN '/' ELSE {sql_path('url')} END AS path FROM pages)
    SELECT page_id, CASE WHEN path LIKE '/article/%' THEN 'article' WHEN path LIKE '/topic/%' THEN 'topic' WHEN path = '/' THEN 'collection' ELSE 'page' END AS kind FROM p""")
def _(spark, sf):
    from ..functions.urls import path_of

    n, path = F.col("page_id") % 4, path_of(F.col("url"))
    shown = F.when(n == 0, F.concat(F.lit("/article"), path)).when(n == 1, F.concat(F.lit("/topic/"), "page_id")).when(n == 2, "/").otherwise(path)
    return table(spark, sf, "pages").select("page_id", H.page_kind(shown).alias("kind"))


@query("tx8_extract_links", """SELECT page_id, unnest(regexp_extract_all(html, '<a\\b[^>]+href=["'']([^"'']+)["'']', 1, 'i')) AS href FROM pages""")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.explode(H.links(F.col("html"))).alias("href"))


@query("tx9_page_counts", """
    WITH v AS (SELECT page_id, regexp_replace(html, '<script(?s:.*?)</script>|<style(?s:.*?)</style>', ' ', 'gi') AS shown FROM pages)
    SELECT page_id, CAST(len(regexp_extract_all(shown, '<h1\\b', 0, 'i')) AS INTEGER) AS h1, CAST(len(regexp_extract_all(shown, '<p\\b', 0, 'i')) AS INTEGER) AS paragraphs FROM v""")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.tag_count(F.col("html"), "h1").alias("h1"), H.tag_count(F.col("html"), "p").alias("paragraphs"))


@query("tx10_feed_probe", with_sql(DATED, """
    SELECT source AS source_id, CAST(count(*) AS INTEGER) AS items, TRUE AS is_feed, strftime(max(date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S') AS newest FROM dated GROUP BY source, lang, doc_id // 100"""))
def _(spark, sf):
    from .sources import feed_payloads

    return feed_payloads(spark, sf).select(
        "source_id", H.feed_item_count(F.col("xml")).alias("items"), H.looks_like_feed(F.col("xml"), F.col("content_type")).alias("is_feed"),
        F.date_format(H.newest_feed_date(F.col("xml")), "yyyy-MM-dd HH:mm:ss").alias("newest"),
    )


@query("tx11_body_char_count", with_sql(ART, f"SELECT doc_id, len(paragraphs) AS n_paragraphs, length(regexp_replace(array_to_string(paragraphs, ''), '[{WS}]', '', 'g')) AS n_body_chars FROM art"))
def _(spark, sf):
    parts = F.col("paragraphs")
    return articles(spark, sf).select("doc_id", F.size(parts).alias("n_paragraphs"), tx.body_char_count(parts).alias("n_body_chars"))


SQL_NUMBERS = f"[lower({sql_squeeze('t')}) for t in regexp_extract_all({{c}}, '{re2(NUMBER_TOKEN.replace('(?i)', '', 1))}', 0, 'i')]"


def sql_numbers(col: str) -> str:
    return SQL_NUMBERS.replace("{c}", col)


# The texts have few numbers, so the source label and the length are appended as claims.
CLAIMED = "text || ' n = ' || n_chars || ' and ' || replace(source, 'src', '') || ' mg, 5 %'"


@query("tx12_numeric_tokens", f"SELECT doc_id, array_to_string({sql_numbers(CLAIMED)}, '|') AS tokens FROM documents")
def _(spark, sf):
    claimed = F.concat("text", F.lit(" n = "), "n_chars", F.lit(" and "), F.replace("source", F.lit("src"), F.lit("")), F.lit(" mg, 5 %"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(tx.numeric_tokens(claimed), "|").alias("tokens"))


@query("tx13_foreign_script", """
    SELECT doc_id, len(list_distinct(regexp_extract_all(text, '[一-鿿぀-ヿЀ-ӿ]+', 0))) + len(list_distinct([t for t in regexp_extract_all(text, '[A-Za-z]{2,}', 0) if regexp_matches(t, '[a-z]')])) AS n_foreign FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(tx.foreign_script(F.col("text"))).alias("n_foreign"))


# Rules over words the texts do contain; the fixed rule list is covered by the tests.
GENERIC_RULES = ((r"(?i)\bthe\b", "THE"), (r"(?i)\bthe(\S+)", "the-$1"), (r"\s+and\s+", " & "))


@query("tx14_apply_rewrite_rules", f"""
    SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text, '\\bthe\\b', 'THE', 'gi'), '{re2(r"\bthe(\S+)")}', 'the-\\1', 'gi'), '{re2(r"\s+and\s+")}', ' & ', 'g')) AS rewritten,
      CAST(len(regexp_extract_all(text, '\\bthe\\b', 0, 'i')) AS INTEGER) AS hits_the, CAST(len(regexp_extract_all(text, '\\bowner\\b', 0, 'i')) AS INTEGER) AS hits_owner FROM documents""".replace(r"(\S+)", f"([^{WS}]+)"))
def _(spark, sf):
    rules = [(p.replace(r"(\S+)", f"([^{WS}]+)"), r) for p, r in GENERIC_RULES]
    out = tx.apply_rewrites(F.col("text"), rules)
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(out).alias("rewritten"),
        count(F.col("text"), rules[0][0]).alias("hits_the"), count(F.col("text"), r"(?i)\bowner\b").alias("hits_owner"),
    )


@query("tx14_rule_hits", """
    SELECT doc_id, r.rule AS rule, CAST(r.hits AS INTEGER) AS hits FROM (SELECT doc_id, unnest([{'rule': 'the', 'hits': len(regexp_extract_all(text, '\\bthe\\b', 0, 'i'))},
      {'rule': 'une', 'hits': len(regexp_extract_all(text, '\\bune\\b', 0, 'i'))}, {'rule': 'owner', 'hits': len(regexp_extract_all(text, '\\bowner\\b', 0, 'i'))}]) AS r FROM documents) WHERE r.hits > 0""")
def _(spark, sf):
    rules = [(rf"(?i)\b{w}\b", "") for w in ("the", "une", "owner")]
    hits = table(spark, sf, "documents").select("doc_id", F.explode(tx.rule_hits(F.col("text"), rules)).alias("r"))
    return hits.select("doc_id", F.regexp_extract("r.rule", r"\\b([a-z]+)\\b", 1).alias("rule"), "r.hits")


@query("tx15_article_text_quality", with_sql(ART, f"""
    , m AS (SELECT doc_id, text, length(text) AS n, len(regexp_extract_all(text, '[{{}};=<>|&$]')) AS symbols,
       regexp_extract_all(text, '[A-Za-z][A-Za-z''-]*') AS words, len(regexp_extract_all(text, '[.!?]["'')\\]]?(?:[{WS}]|$)')) AS sentences,
       list_distinct(regexp_extract_all(lower(title), '[a-z]{{5,}}')) AS tw FROM art)
    SELECT doc_id, CASE WHEN n < 400 THEN 'too-short' WHEN symbols / n > 0.012 THEN 'looks-like-code'
      WHEN len(words) >= 40 AND len([w for w in words if regexp_matches(w, '^[A-Z]')]) / len(words) > 0.4 THEN 'looks-like-navigation'
      WHEN sentences = 0 OR n / sentences > 300 THEN 'looks-like-navigation'
      WHEN len(tw) >= 3 AND len([w for w in tw if contains(lower(text), w)]) / len(tw) < 0.34 THEN 'title-mismatch' ELSE 'ok' END AS verdict FROM m"""))
def _(spark, sf):
    return articles(spark, sf).select("doc_id", tx.article_text_quality(F.col("text"), F.col("title")).alias("verdict"))


def sql_bibliographic(col: str) -> str:
    marks = " + ".join(f"CAST(regexp_matches({col}, '{re2(p.replace('(?i)', ''))}', 'i') AS INTEGER)" for p in BIBLIOGRAPHIC_MARKERS)
    head = f"(CASE WHEN regexp_matches({col}, '\\bIn:', 'i') THEN substr({col}, 1, length(regexp_extract({col}, '^((?s:.*?))\\bIn:', 1, 'i'))) ELSE {col} END)"
    return (f"CASE WHEN {col} = '' THEN TRUE WHEN ({marks}) < 2 THEN FALSE ELSE NOT regexp_matches({head}, '{re2(NARRATIVE.replace('(?i)', ''))}', 'i') "
            f"AND length({head}) < 700 END")


@query("tx16_bibliographic_only", with_sql(ART, f"""
    , d AS (SELECT doc_id, {sql_squeeze("CASE doc_id % 3 WHEN 0 THEN text ELSE title || ' Research output › In: Journal of ' || lang END")} AS s FROM art)
    SELECT doc_id, {sql_bibliographic("s")} AS bibliographic FROM d"""))
def _(spark, sf):
    s = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.concat("title", F.lit(" Research output › In: Journal of "), "lang"))
    return articles(spark, sf).select("doc_id", tx.bibliographic_only(s).alias("bibliographic"))


@query("tx17_parse_count", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_quantity < 10 THEN 5.0 ELSE l_extendedprice END AS parsed, l_discount * 1.0 AS measured FROM lineitem""")
def _(spark, sf):
    raw = F.when(F.col("l_quantity") < 10, F.lit(" < 10 ")).otherwise(F.format_number("l_extendedprice", 2))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", tx.parse_count(raw).alias("parsed"),
        tx.parse_measure(F.concat(F.col("l_discount").cast("string"), F.lit(" %"))).alias("measured"),
    )


STOP = ("small", "large")


@query("tx18_coverage_tokens", """
    SELECT p_partkey, array_to_string([w for w in string_split(p_name, ' ') if length(w) >= 2 AND w NOT IN ('small', 'large')], '|') AS tokens FROM part""")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.array_join(tx.coverage_tokens(F.col("p_name"), STOP), "|").alias("tokens"))


@query("tx19_lead_repeats_body", with_sql(ART, f"""
    SELECT doc_id, title <> '' AND regexp_replace(title, '[{WS}]', '', 'g') = regexp_replace(coalesce(paragraphs[1], ''), '[{WS}]', '', 'g') AS repeats FROM art"""))
def _(spark, sf):
    return articles(spark, sf).select("doc_id", tx.lead_repeats_body(F.col("title"), F.col("paragraphs")).alias("repeats"))


@query("tx20_term_hits", "SELECT doc_id, CAST(len(list_distinct([lower(t) for t in regexp_extract_all(text, 'tion|ther|cat|clinical|journal', 0, 'i')])) AS INTEGER) AS hits, regexp_matches(text, 'cat|clinical', 'i') AS any_hit FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tx.term_hits(F.col("text"), "tion|ther|cat|clinical|journal").alias("hits"), tx.any_term(F.col("text"), "cat|clinical").alias("any_hit")
    )


@query("tx_nfkc_title", with_sql(ART, f"SELECT doc_id, trim('abc 1 ffi ' || {sql_title('title')}) AS normal_title FROM art"))
def _(spark, sf):
    """Titles that begin with full-width letters, a circled digit inside a tag and a ligature."""
    return articles(spark, sf).select("doc_id", tx.normalize_title(F.concat(F.lit("ＡＢＣ<b>①</b> ﬃ "), "title")).alias("normal_title"))
