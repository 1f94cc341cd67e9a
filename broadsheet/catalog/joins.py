"""Queries for filters, joins and set operations (FL*, JN*, SO*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls
from ..functions.patterns import compact
from ..operators import filters as FL
from ..operators import joins as J
from ..operators import rules as R
from ..operators import coverage, search, setops, similarity
from ..operators.pages import with_meta
from ..plans import audits, resolution
from ..session import cut_lineage, shared_folder
from ..sources.feeds import official
from . import query
from .identity import registry_domains, sql_tokens
from .rules import DEMO_TOPICS
from .tables import ART, DATED, ITEMS, NOW, articles, dated, items, now, sql_host, sql_normal_url, sql_path, table, with_sql


@query("fl1_social_rule", "SELECT event_id FROM events WHERE event_type NOT IN ('error', 'signup') AND user_id % 2 = 0 AND value >= 20 AND length(props) * 20 >= 150")
def _(spark, sf):
    e = table(spark, sf, "events")
    return e.where(
        FL.social_rule(F.col("event_type") == "error", F.col("event_type") == "signup", F.col("user_id") % 2 == 0, F.col("value"), F.repeat("props", 20), 20)
        & (F.length("props") * 20 >= 150)
    ).select("event_id")


@query("fl2_recent_enough", f"SELECT event_id FROM events WHERE CASE event_type WHEN 'error' THEN FALSE WHEN 'signup' THEN TRUE ELSE date_trunc('second', ts) >= TIMESTAMP '{NOW}' - INTERVAL 10 DAY END")
def _(spark, sf):
    raw = F.when(F.col("event_type") == "error", "not a date").when(F.col("event_type") == "signup", "").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf, "events").where(FL.recent_enough(raw, now(), 10)).select("event_id")


@query("fl3_not_paywalled", "SELECT doc_id FROM documents WHERE NOT regexp_matches(text || CASE WHEN source = 'src3' THEN ' Members Only' ELSE '' END, 'members only|log in/register', 'i')")
def _(spark, sf):
    body = F.concat("text", F.when(F.col("source") == "src3", " Members Only").otherwise(""))
    return table(spark, sf, "documents").where(FL.not_paywalled(body)).select("doc_id")


@query("fl4_recent_window", f"SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-28' AND ts <= TIMESTAMP '2024-01-30' ORDER BY ts DESC, event_id LIMIT 1000")
def _(spark, sf):
    e = FL.recent_window(table(spark, sf, "events"), "ts", F.lit("2024-01-30").cast("timestamp"), 2, 1000, [F.col("event_id")])
    return e.select("event_id", "user_id")


@query("fl5_visible", with_sql(ITEMS, f"SELECT doc_id FROM items WHERE coalesce(visibility, '') <> 'suppressed' AND (scheduled_at IS NULL OR scheduled_at <= TIMESTAMP '2024-01-06')"))
def _(spark, sf):
    return items(spark, sf).where(FL.visible(F.col("visibility"), F.col("scheduled_at"), F.lit("2024-01-06").cast("timestamp"))).select("doc_id")


@query("fl6_queue_filter", with_sql(ITEMS, """
    SELECT 'editorial:' || id AS id FROM items WHERE workflow_status = 'correction-required' AND (contains(lower(title), 'ther') OR contains('editorial:' || id, 'ther'))"""))
def _(spark, sf):
    from .jobs import editorial_rows
    from ..operators import tasks

    t = tasks.editorial_tasks(editorial_rows(items(spark, sf)))
    return t.where(FL.queue_filter("correction", "critical", " THER ")).select("id")


@query("fl7_drop_seen", f"SELECT page_id FROM pages WHERE {sql_normal_url('url')} NOT IN (SELECT {sql_normal_url('url')} FROM pages WHERE page_id % 2 = 0)")
def _(spark, sf):
    p = table(spark, sf, "pages")
    seen = p.where("page_id % 2 = 0").select(urls.normalize_url(F.col("url")).alias("key"))
    return FL.drop_seen(p, "page_id", urls.source_keys(F.col("url")), seen, "key").select("page_id")


@query("fl8_needs_backfill", with_sql(ITEMS, """
    SELECT doc_id FROM items WHERE workflow_status <> 'published' AND content_tier = 'brief' AND coalesce(clinical_risk, '') <> 'high' AND source_status = 'verified' AND duplicate_status = 'unique'
      AND (length(regexp_replace(array_to_string(paragraphs, ''), '\\s', '', 'g')) < 250 OR title = '' OR lead = '')
      AND source_url NOT IN (SELECT source_url FROM items WHERE workflow_status = 'published')"""))
def _(spark, sf):
    i = items(spark, sf)
    done = i.where("workflow_status = 'published'").select(urls.normalize_url(F.col("source_url")).alias("source_key"))
    rows = i.withColumn("source_key", urls.normalize_url(F.col("source_url")))
    cols = {c: F.col(c) for c in ("workflow_status", "content_tier", "clinical_risk", "source_status", "duplicate_status", "source_key", "title", "lead")}
    hit = rows.where(FL.needs_backfill({**cols, "body_chars": F.col("_chars")}))
    return hit.join(done, "source_key", "left_anti").select("doc_id")


@query("fl9_enabled_sources", "SELECT s_suppkey FROM supplier WHERE s_acctbal > 0 AND s_name = 'Supplier#000000001'")
def _(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", urls.source_id(F.col("s_name")).alias("id"), F.col("s_name").alias("label"), (F.col("s_acctbal") > 0).alias("enabled"))
    return FL.enabled_sources(s, "Supplier#000000001").select("s_suppkey")


@query("fl10_keyword_in_context", "SELECT p_partkey FROM part WHERE regexp_matches(p_name, 'ring|bolt')")
def _(spark, sf):
    return table(spark, sf, "part").where(FL.keyword_in_context(F.col("p_name"), "ring|bolt")).select("p_partkey")


@query("fl11_search", with_sql(ITEMS, """
    SELECT doc_id FROM items WHERE category = 'en' AND contains(lower(concat_ws(' ', title, lead, source_label, text)), 'there') AND event_type <> 'view'"""))
def _(spark, sf):
    i = items(spark, sf)
    hits = FL.search(i, " There", [F.col("title"), F.col("lead"), F.col("source_label"), F.col("text")], "en", i.where("event_type = 'view'").select("doc_id"), "doc_id")
    return hits.select("doc_id")


@query("fl11_indexed_search", with_sql(ITEMS, """
    SELECT doc_id FROM items WHERE category = 'en' AND contains(lower(concat_ws(' ', title, lead, source_label, text)), 'ther th') AND event_type <> 'view'"""))
def _(spark, sf):
    """The search over monthly chunks and their postings, which are written first."""
    i = items(spark, sf).withColumn("month", F.date_format("date", "yyyy-MM"))
    path = shared_folder(spark, "search")
    search.write_index(i.select("doc_id", "month", "category", "event_type", "title", "lead", "source_label", "text"), "doc_id", "month", ["title", "lead", "source_label", "text"], path)
    seen = spark.read.parquet(f"{path}/chunks").where("event_type = 'view' OR event_type IS NULL").select("doc_id")
    return search.search_index(spark, path, " Ther tH ", "en", seen, "doc_id").select("doc_id")


@query("jn1_attach_scores", "SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def _(spark, sf):
    return J.attach_scores(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id").select("doc_id", "source", "quality", "toxic")


@query("jn2_attach_dimension", "SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def _(spark, sf):
    s = J.attach_dimension(table(spark, sf, "supplier"), table(spark, sf, "nation"), "s_nationkey", "n_nationkey")
    return J.attach_dimension(s, table(spark, sf, "region"), "n_regionkey", "r_regionkey").select("s_suppkey", "n_name", "r_name")


ORDER_KEYS = "list_distinct(['c' || o_custkey, 'd' || strftime(o_orderdate, '%Y-%m-%d')])"


def order_keys():
    return F.array_distinct(F.array(F.concat(F.lit("c"), "o_custkey"), F.concat(F.lit("d"), F.date_format("o_orderdate", "yyyy-MM-dd"))))


def known_keys(spark, sf):
    o = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND o_totalprice > 450000")
    return o.select(F.explode(order_keys()).alias("key"))


SQL_KNOWN = f"known AS (SELECT DISTINCT unnest({ORDER_KEYS}) AS key FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 450000), keyed AS (SELECT o_orderkey, unnest({ORDER_KEYS}) AS key FROM orders)"


@query("jn3_semi_any_key", with_sql(SQL_KNOWN, "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM keyed JOIN known USING (key))"))
def _(spark, sf):
    return J.having_any_key(table(spark, sf, "orders"), "o_orderkey", order_keys(), known_keys(spark, sf), "key").select("o_orderkey")


@query("jn4_anti_any_key", with_sql(SQL_KNOWN, "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM keyed JOIN known USING (key))"))
def _(spark, sf):
    return J.having_no_key(table(spark, sf, "orders"), "o_orderkey", order_keys(), known_keys(spark, sf), "key").select("o_orderkey")


@query("jn5_match_domain", f"SELECT page_id, CASE WHEN {sql_host('url')} LIKE '%.example.com' OR {sql_host('url')} = 'example.com' THEN 'example.com' WHEN {sql_host('url')} LIKE '%example.net' THEN 'example.net' END AS domain FROM pages")
def _(spark, sf):
    return J.match_domain(table(spark, sf, "pages"), "url", registry_domains(spark, sf), "domain", "page_id").select("page_id", "domain")


def title_sets(spark, sf):
    return articles(spark, sf).select("doc_id", "source", "title", F.sort_array(tx.title_tokens(F.col("title"))).alias("words"))


SQL_SETS = ART + f", ts AS (SELECT doc_id, source, list_sort({sql_tokens('title')}) AS words FROM art), su AS (SELECT words, min(doc_id) AS doc_id FROM ts WHERE len(words) > 0 GROUP BY words)"
SQL_SIM = "round(len(list_intersect(a.words, b.words)) / greatest(len(a.words), len(b.words)), 3)"


@query("jn6_similar_titles", with_sql(SQL_SETS, f"""
    , a0 AS (SELECT words, min(doc_id) AS doc_id FROM ts WHERE len(words) > 0 AND doc_id % 2 = 0 GROUP BY words), b0 AS (SELECT words, min(doc_id) AS doc_id FROM ts WHERE len(words) > 0 AND doc_id % 2 = 1 GROUP BY words),
    p AS (SELECT a.doc_id AS left_id, b.doc_id AS right_id, {SQL_SIM} AS similarity FROM a0 a JOIN b0 b ON len(list_intersect(a.words, b.words)) > 0 WHERE {SQL_SIM} >= 0.5),
    r AS (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY similarity DESC, right_id) AS rn FROM p) SELECT left_id, right_id, similarity FROM r WHERE rn = 1"""))
def _(spark, sf):
    """For each title of an even document the most similar title of an odd one, at least 0.5 alike."""
    # A filter before the checkpoint would be pushed to the texts, which then pass through the title functions twice.
    sets = cut_lineage(title_sets(spark, sf).select("doc_id", "words")).where(F.size("words") > 0)
    one = lambda rest: sets.where(F.col("doc_id") % 2 == rest).groupBy("words").agg(F.min("doc_id").alias("doc_id"))
    return similarity.best_similar(one(0), one(1), "doc_id", "doc_id", "doc_id", "words", 0.5)


@query("jn6_earliest_similar", with_sql(SQL_SETS, f"""
    SELECT a.doc_id, (SELECT min(b.doc_id) FROM ts b WHERE b.doc_id < a.doc_id AND len(b.words) > 0 AND len(a.words) > 0 AND {SQL_SIM} >= 0.9) AS similar_to FROM ts a"""))
def _(spark, sf):
    """First earlier document whose title is at least 0.9 alike."""
    return similarity.earliest_similar(title_sets(spark, sf), "doc_id", "doc_id", "words", 0.9).select("doc_id", "similar_to")


@query("jn7_band_join", """
    SELECT a.o_orderkey AS left_key, b.o_orderkey AS right_key, abs(date_diff('day', a.o_orderdate, b.o_orderdate)) AS gap FROM orders a JOIN orders b
      ON a.o_custkey = b.o_custkey AND abs(date_diff('day', a.o_orderdate, b.o_orderdate)) <= 3 WHERE a.o_orderstatus = 'F' AND b.o_orderstatus = 'O'""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    left = o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("left_key"), "o_custkey", F.col("day").alias("left_day"))
    right = o.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("right_key"), "o_custkey", F.col("day").alias("right_day"))
    j = J.band_join(left, right, "o_custkey", "left_day", "right_day", 3)
    return j.select("left_key", "right_key", F.abs(F.date_diff("left_day", "right_day")).cast("long").alias("gap"))


SQL_RESOLVED = SQL_SETS.replace("SELECT doc_id, source, list_sort", "SELECT doc_id, source, lang, ts, list_sort").replace("FROM art)", "FROM dated)").replace(ART, DATED) + f"""
, c AS (SELECT a.doc_id, b.doc_id AS candidate, {SQL_SIM} AS similarity, round(abs(epoch_us(a.ts) - epoch_us(b.ts)) / 86400000000.0, 1) AS gap FROM ts a JOIN ts b ON a.doc_id % 2 = 0 AND b.doc_id % 2 = 1 AND a.lang = b.lang AND b.lang IN ('en', 'fr')
   AND len(a.words) > 0 AND len(b.words) > 0 AND len(list_intersect(a.words, b.words)) > 0 WHERE {SQL_SIM} >= 0.62),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, coalesce(gap, 999), candidate) AS place FROM c QUALIFY place <= 5),
st AS (SELECT d.doc_id, CASE WHEN l.quality = 1 AND d.doc_id % 5 = 0 AND d.lang IN ('en', 'fr') THEN 'manually-approved' WHEN l.quality = 0 THEN 'rejected'
     WHEN r.similarity >= 0.92 AND (r.gap IS NULL OR r.gap <= 3) THEN 'resolved' WHEN r.similarity IS NOT NULL THEN 'candidate' ELSE 'unresolved' END AS status, d.lang IN ('en', 'fr') AS mapped
   FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id AND r.place = 1 LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE d.doc_id % 2 = 0)"""


@query("jn7_resolve_sources", with_sql(SQL_RESOLVED, """
    SELECT st.doc_id, r.candidate, r.similarity, r.gap, CAST(r.place AS INTEGER) AS place, st.status,
      CASE st.status WHEN 'manually-approved' THEN 'explicit-editor-approval' WHEN 'rejected' THEN 'explicit-editor-rejection' WHEN 'resolved' THEN 'high-confidence-official-direct-match'
        WHEN 'candidate' THEN 'medium-confidence-needs-human-review' ELSE CASE WHEN mapped THEN 'official-domain-mapped-no-verified-candidate' ELSE 'publisher-domain-not-mapped' END END AS reason
    FROM st LEFT JOIN r ON r.doc_id = st.doc_id"""))
def _(spark, sf):
    """The five best direct candidates (odd ids) of each relay item (even ids) of the same source label (the language), on an
    official domain, with the status that they lead to. The text before the first mark stands for the title, labels for the
    decisions of editors."""
    url = F.concat(F.lit("https://"), "lang", F.lit(".example.com/a/"), F.col("doc_id").cast("string"))
    d = dated(spark, sf).select("doc_id", F.col("lang").alias("label"), "ts", url.alias("url"), F.sort_array(tx.title_tokens(F.col("title"))).alias("words"))
    domains = F.array(F.lit("en.example.com"), F.lit("fr.example.com"))
    relay, direct = d.where("doc_id % 2 = 0"), d.where("doc_id % 2 = 1").where(official(F.col("url"), domains)).select("doc_id", "label", "ts", "words")
    decision = F.when((F.col("quality") == 1) & (F.col("doc_id") % 5 == 0), "manually-approved").when(F.col("quality") == 0, "rejected")
    decisions = table(spark, sf, "labels").select("doc_id", decision.alias("decision"))
    asked = relay.select("doc_id", "label", "ts", "words", official(F.col("url"), domains).alias("mapped")).join(decisions, "doc_id", "left")
    return resolution.resolve_sources(asked, direct, "doc_id").withColumnRenamed("rank", "place").select("doc_id", "candidate", "similarity", "gap", "place", "status", "reason")


@query("jn8_fallback_join", """
    WITH t AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS aid, user_id AS cust, CAST(date_trunc('day', TIMESTAMP '1996-01-01' + to_days(CAST(event_id % 100 AS INTEGER))) AS DATE) AS day FROM events),
    a AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders),
    b AS (SELECT o_custkey, day, arg_max(o_orderkey, o_orderkey) AS k FROM a GROUP BY ALL)
    SELECT event_id, coalesce(x.o_orderkey, b.k) AS order_key FROM t LEFT JOIN a x ON x.o_orderkey = t.aid LEFT JOIN b ON b.o_custkey = t.cust AND b.day = t.day""")
def _(spark, sf):
    tasks = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("event_id")).alias("task_article_id"), F.col("user_id").alias("task_title"),
        F.date_add(F.lit("1996-01-01").cast("date"), (F.col("event_id") % 100).cast("int")).alias("task_date"),
    )
    arts = table(spark, sf, "orders").select(F.col("o_orderkey").alias("article_id"), F.col("o_custkey").alias("article_title"), F.to_date("o_orderdate").alias("article_date"), F.col("o_orderkey").alias("article_ord"))
    return J.attach_by_id_or_title(tasks, arts, ["article_id"]).select("event_id", F.col("article.article_id").alias("order_key"))


@query("jn9_dictionary_join", """
    SELECT doc_id, unnest([x for x in ['ing', 'tion', 'eau', 'lich'] if contains(lower(text), x) OR (x = 'lich' AND contains(lower(text), 'sch'))]) AS slug FROM documents""")
def _(spark, sf):
    hits = F.array_compact(F.array(*[F.when(tx.term_count(F.col("text"), m) > 0, F.lit(s)) for s, m in DEMO_TOPICS]))
    return table(spark, sf, "documents").select("doc_id", F.explode(hits).alias("slug"))


STOP = ("the", "and", "of", "en", "de", "la")
CONTEXT = "th|on|re|ci"
DEMANDS = [("tion", "tion", None), ("es", "es", "tion")]


def keywords(spark, sf):
    """Neighbouring words of the benchmark passages as keywords, with a volume."""
    b = table(spark, sf, "benchmark").select("item_id", "text", F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("ws"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("ws") - 1), lambda i: F.concat_ws(" ", F.element_at("ws", i), F.element_at("ws", i + 1)))
    volume = (F.length("text") * (F.col("item_id") % 7)).cast("long")
    return audits.analysed_keywords(b.where(F.size("ws") > 1).select(volume.alias("volume"), F.explode(pairs).alias("keyword")), CONTEXT, DEMO_TOPICS, STOP)


SQL_KEYWORDS = r"""kr AS (SELECT length(text) * (item_id % 7) AS volume, unnest([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]) AS keyword
  FROM (SELECT *, [w for w in regexp_split_to_array(text, '\s+') if w <> ''] AS ws FROM benchmark)),
kt AS (SELECT keyword, CAST(max(volume) AS BIGINT) AS volume, [len(regexp_extract_all(keyword, m, 0, 'i')) for m in ['ing', 'tion', 'eau', 'lich|sch']] AS hits,
  [w for w in regexp_split_to_array(keyword, '[ ·,/]+') if length(w) >= 2 AND w NOT IN ('the', 'and', 'of', 'en', 'de', 'la')] AS tokens FROM kr WHERE regexp_matches(keyword, 'th|on|re|ci') GROUP BY keyword),
kw AS (SELECT keyword, volume, tokens, CASE WHEN list_max(hits) > 0 THEN ['ing', 'tion', 'eau', 'lich'][list_position(hits, list_max(hits))] END AS topic FROM kt)"""
SQL_COVER = """cover AS (SELECT keyword, doc_id, title FROM kw JOIN art ON title <> '' AND len(tokens) > 0 AND len([t for t in tokens if NOT contains(title || ' ' || coalesce(paragraphs[1], ''), t)]) = 0)"""


def shown_articles(spark, sf):
    """Articles with a title, and their lead."""
    return articles(spark, sf).where("title <> ''").withColumn("lead", F.try_element_at("paragraphs", F.lit(1)))


@query("jn10_covering_documents", with_sql(f"{ART}, {SQL_KEYWORDS}, {SQL_COVER}", "SELECT keyword, count(*) AS n_docs FROM cover GROUP BY keyword"))
def _(spark, sf):
    """Documents whose title and lead hold all words of a keyword."""
    docs = shown_articles(spark, sf).select("doc_id", F.concat_ws(" ", "title", "lead").alias("shown"))
    return coverage.counted(coverage.covering(keywords(spark, sf), "keyword", "tokens", docs, "doc_id", "shown"), "keyword")


@query("jn11_snapshot_diff", """
    WITH p AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O'), c AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
    SELECT coalesce(p.o_orderkey, c.o_orderkey) AS o_orderkey, CASE WHEN p.o_orderkey IS NULL THEN 'added' WHEN c.o_orderkey IS NULL THEN 'removed' ELSE 'kept' END AS change FROM p FULL JOIN c ON p.o_orderkey = c.o_orderkey""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    return J.snapshot_diff(o.where("o_orderstatus <> 'O'"), o.where("o_orderstatus <> 'F'"), "o_orderkey")


def link_edges(spark, sf):
    from ..functions import html

    return table(spark, sf, "pages").select("page_id", F.explode(html.links(F.col("html"))).alias("href"))


SQL_EDGES = """e AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\\b[^>]+href=["'']([^"'']+)["'']', 1, 'i')) AS href FROM pages)"""


@query("jn12_broken_links", with_sql(SQL_EDGES, f"""
    SELECT page_id, href FROM e WHERE href LIKE '/%' AND href NOT LIKE '//%' AND href NOT LIKE '/api/%' AND href NOT LIKE '/search%'
      AND regexp_replace(href, '[?#].*$', '') NOT IN (SELECT {sql_path('url')} FROM pages)"""))
def _(spark, sf):
    known = table(spark, sf, "pages").select(urls.path_of(F.col("url")).alias("page_path"))
    return J.broken_links(link_edges(spark, sf), "href", known, "page_path").select("page_id", "href")


@query("jn13_sitemap_issues", f"""
    WITH s AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN url || '/gone' ELSE url END AS loc FROM pages), u AS (SELECT DISTINCT url FROM pages)
    SELECT s.page_id, CASE WHEN u.url IS NULL THEN 'target-missing' ELSE 'canonical-mismatch' END AS reasons FROM s LEFT JOIN u ON u.url = s.loc""")
def _(spark, sf):
    p = table(spark, sf, "pages")
    listed = p.select("page_id", F.when(F.col("page_id") % 5 == 0, F.concat("url", F.lit("/gone"))).otherwise(F.col("url")).alias("loc"))
    meta = with_meta(p).select(F.col("url").alias("page_url"), "robots", "canonical").dropDuplicates(["page_url"])
    return J.sitemap_issues(listed, "loc", meta).select("page_id", F.array_join("reasons", ",").alias("reasons"))


@query("jn14_class_agreement", with_sql(f"{ART}, {SQL_KEYWORDS}, {SQL_COVER}", """
    SELECT keyword, count(*) AS n_docs, min(doc_id) AS first_id FROM cover
    WHERE (NOT contains(keyword, 'tion') OR contains(title, 'tion')) AND (NOT contains(keyword, 'es') OR contains(keyword, 'tion') OR contains(title, 'es')) GROUP BY keyword"""))
def _(spark, sf):
    """Covering documents whose title is of the class that the keyword names."""
    docs = shown_articles(spark, sf).select("doc_id", F.concat_ws(" ", "title", "lead").alias("shown"), coverage.classes_of(F.col("title"), [(n, p) for n, p, _ in DEMANDS]).alias("classes"))
    kw = keywords(spark, sf).where(F.size("tokens") > 0).withColumn("needed", F.concat("tokens", coverage.class_terms(F.col("keyword"), DEMANDS)))
    found = cut_lineage(coverage.covering(kw, "keyword", "needed", docs, "doc_id", "shown", "classes"))
    first = coverage.first_documents(found, "keyword", "first_id", 1).drop("rank")
    return coverage.counted(found, "keyword").join(first, "keyword")


@query("jn15_latest_state", """
    WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    SELECT c_custkey, event_id, event_type FROM customer LEFT JOIN l ON l.user_id = c_custkey AND rn = 1""")
def _(spark, sf):
    e = table(spark, sf, "events").withColumnRenamed("user_id", "c_custkey")
    return J.latest_state(table(spark, sf, "customer"), e, "c_custkey", [F.col("ts").desc(), F.col("event_id").desc()]).select("c_custkey", "event_id", "event_type")


@query("so1_union_sources", """
    SELECT doc_id AS id, source AS label, NULL::DOUBLE AS score FROM documents UNION ALL SELECT event_id, event_type, value FROM events UNION ALL SELECT page_id, NULL, NULL FROM pages""")
def _(spark, sf):
    return setops.union_sources(
        table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("label")),
        table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("label"), F.col("value").alias("score")),
        table(spark, sf, "pages").select(F.col("page_id").alias("id")),
    )


@query("so2_removed_keys", """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'allowed' ELSE 'unexpected' END AS verdict FROM orders WHERE o_orderstatus = 'F'""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    return setops.removed_keys(o, o.where("o_orderstatus <> 'F'"), o.where("o_orderpriority = '5-LOW'"), "o_orderkey")


@query("so3_intersection", "SELECT lang, source FROM documents WHERE n_chars > 1000 INTERSECT SELECT lang, source FROM documents WHERE n_chars < 300")
def _(spark, sf):
    d = table(spark, sf, "documents")
    return setops.shared_values(d.where("n_chars > 1000").select("lang", "source"), d.where("n_chars < 300").select("lang", "source"))


@query("so4_distinct_union", "SELECT n_name AS label FROM nation UNION SELECT source FROM documents UNION SELECT r_name FROM region")
def _(spark, sf):
    return setops.distinct_union(
        table(spark, sf, "nation").select(F.col("n_name").alias("label")), table(spark, sf, "documents").select("source"), table(spark, sf, "region").select("r_name")
    )
