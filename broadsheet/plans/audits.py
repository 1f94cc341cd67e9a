"""JB5, JB6, JB7, JB9, JB11-JB13, JB15: corpus audits and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import KEYWORD_STOPWORDS, TOPICS
from ..functions import html as H
from ..functions import text as tx
from ..functions.urls import clean_image_url, image_key, normalize_url, path_of, stable_item_id
from ..operators import aggregate, coverage, dedup, filters, joins, monitor, pages, rules, setops, topk, windows


def validate_pages(site: DataFrame, sitemap: DataFrame) -> DataFrame:
    """JB5. (check, subject, detail) findings over pages (page_id, url, html) and sitemap rows (loc)."""
    meta = pages.with_meta(site).withColumn("page_url", F.col("url"))
    repeated = dedup.repeated_values(meta, "page_id", {"title": F.col("title"), "description": F.col("description"), "canonical": F.col("canonical")})
    repeated = repeated.select(F.concat(F.lit("duplicate-"), "field").alias("check"), F.col("value").alias("subject"), F.col("n_rows").cast("string").alias("detail"))
    edges = site.select("page_id", F.explode(H.links(F.col("html"))).alias("href"))
    known = site.select(path_of(F.col("url")).alias("page_path"))
    broken = joins.broken_links(edges, "href", known, "page_path")
    broken = broken.groupBy("href").agg(F.count("*").alias("n")).select(F.lit("broken-link").alias("check"), F.col("href").alias("subject"), F.col("n").cast("string").alias("detail"))
    one = dedup.first_per_key(meta.select("page_url", "robots", "canonical", "page_id"), ["page_url"], [F.col("page_id")]).drop("page_id")
    listed = joins.sitemap_issues(sitemap, "loc", one).select(F.explode("reasons").alias("check"), F.col("loc").alias("subject"), F.lit("").alias("detail"))
    bad_ld = site.where(H.jsonld_errors(F.col("html")) > 0).select(F.lit("jsonld-parse").alias("check"), F.col("url").alias("subject"), F.lit("").alias("detail"))
    return setops.union_sources(repeated, broken, listed, bad_ld)


def seo_audit(site: DataFrame) -> DataFrame:
    """JB6. Findings of the page contract per kind and code, and thin pages."""
    checked = pages.page_contract(site).withColumn("paragraphs", H.tag_count(F.col("html"), "p"))
    thin = F.when(F.col("paragraphs") < 3, F.array(F.lit("index-under-three-paragraphs"))).otherwise(F.array().cast("array<string>"))
    return checked.select("kind", F.explode(F.concat("codes", thin)).alias("code")).groupBy("kind", "code").agg(F.count("*").alias("n"))


def operations_summary(items: DataFrame, reviews: DataFrame, index_ids: DataFrame, source_decisions: DataFrame, image_decisions: DataFrame) -> DataFrame:
    """JB7. One row of operation figures: publication, sources, review queue, images, gates."""
    latest = dedup.first_per_key(reviews, ["id"], [F.col("review_ord").desc()]).select("id", F.col("new_status").alias("latest_status"))
    # Several decisions for one item count once: the last by decision_ord where there is one.
    last = [F.col("decision_ord").desc()] if "decision_ord" in source_decisions.columns else [F.col("status").desc()]
    decided = dedup.first_per_key(source_decisions, ["id"], last).select("id", F.col("status").alias("source_decision"))
    flags = (
        items.join(index_ids.select("id", F.lit(True).alias("_idx")).distinct(), "id", "left")
        .join(latest, "id", "left")
        .join(decided, "id", "left")
        .join(image_decisions.select("id", F.lit(True).alias("image_decided")).distinct(), "id", "left")
    )
    risk, role = rules.clinical_risk(), rules.required_role()
    status = rules.workflow_status(legacy=True)
    vet = F.col("vet_reviewed_at").isNotNull() & (F.coalesce("vet_reviewer", F.lit("")) != "")
    editor = F.col("reviewed_at").isNotNull() & (F.coalesce("reviewed_by", F.lit("")) != "")
    reviewed = F.when(role == "vet", vet | (status == "vet-reviewed")).otherwise(editor | vet | status.isin("editor-reviewed", "vet-reviewed"))
    news = F.coalesce(F.col("publication_status") == "index-news", F.lit(False))
    slim = flags.select(
        F.coalesce("_idx", F.lit(False)).alias("idx"), risk.alias("risk"), reviewed.alias("reviewed"), news.alias("news"), rules.image_external().alias("external"),
        rules.image_ownership().alias("ownership"), F.coalesce("image_decided", F.lit(False)).alias("decided"), F.col("source_status"), F.col("source_decision"), F.col("latest_status"),
    )
    waiting = F.col("idx") & ~F.col("news") & ~F.col("reviewed") & F.col("risk").isin("high", "medium")
    unresolved = (F.col("source_status") == "unresolved") & (F.col("source_decision").isNull() | ~F.col("source_decision").isin("manually-approved", "rejected"))
    pending = F.col("external") & (F.col("ownership") == "unknown") & ~F.col("decided")
    out = slim.agg(
        F.count("*").alias("total"), F.count_if("idx").alias("indexed"), F.count_if(F.coalesce(unresolved, F.lit(False))).alias("unresolved"),
        F.count_if(waiting & (F.col("risk") == "high")).alias("high_waiting"), F.count_if(waiting & (F.col("risk") == "medium")).alias("medium_waiting"),
        F.count_if(F.coalesce(pending, F.lit(False))).alias("images_pending"), F.count_if(F.col("idx") & F.col("news")).alias("automatic"),
        F.count_if(F.col("latest_status").isNotNull()).alias("with_review"),
    )
    queue = F.col("high_waiting") + F.col("medium_waiting")
    return out.withColumns(
        {
            "index_rate": F.round(F.col("indexed") / F.greatest(F.lit(1), F.col("total")), 4), "can_increase_index": (F.col("unresolved") == 0) & (queue == 0),
            "needs_people": (F.col("unresolved") > 0) | (queue > 0) | (F.col("images_pending") > 0),
        }
    )


def analysed_keywords(rows: DataFrame, context: str | None = None, topics=TOPICS, stopwords=KEYWORD_STOPWORDS) -> DataFrame:
    """JB9. (keyword, volume, topic, tokens) from rows of (keyword, volume): the largest volume of a keyword, keywords of the
    context only, and the topic with the most hits (the first of equals)."""
    best = rows.where(F.col("keyword") != "").groupBy("keyword").agg(F.max("volume").alias("volume"))
    if context:
        best = best.where(filters.keyword_in_context(F.col("keyword"), context))
    return best.withColumns({"topic": topk.main_topic(F.col("keyword"), topics), "tokens": tx.coverage_tokens(F.col("keyword"), stopwords)})


def keyword_gaps(keywords: DataFrame, docs: DataFrame, ordinal: str, title: str, lead: str, minimum: int = 100) -> DataFrame:
    """JB9, CL42. Keywords (keyword, volume, tokens, ..) with the number of documents whose title and lead hold all tokens,
    and a verdict. Documents without a title and keywords without tokens do not count."""
    shown = docs.where(F.coalesce(F.col(title), F.lit("")) != "").select(ordinal, F.concat_ws(" ", title, lead).alias("_shown"))
    found = coverage.covering(keywords, "keyword", "tokens", shown, ordinal, "_shown")
    out = keywords.join(coverage.counted(found, "keyword", "articles"), "keyword", "left").withColumn("articles", F.coalesce("articles", F.lit(0)))
    wanted = F.col("volume") >= minimum
    return out.withColumn("verdict", F.when(wanted & (F.col("articles") == 0), "gap").when(wanted, "strong").otherwise("small"))


def content_kit(
    keywords: DataFrame, docs: DataFrame, ordinal: str, haystack: str, classes: str, terms: str, demands: Column, minimum: int = 500, k: int = 5,
) -> DataFrame:
    """JB9. (keyword, ordinal, rank): the first ``k`` documents that hold all known words of a keyword and are of the classes
    that ``demands`` (class terms over the keyword) asks for. ``terms`` is the pattern of known words, of which a keyword needs
    two."""
    known = F.filter(F.array_distinct(F.regexp_extract_all("keyword", F.lit(f"({terms})"), F.lit(1))), lambda t: F.length(t) >= 2)
    wanted = keywords.where(F.col("volume") >= minimum).withColumn("_known", known).where(F.size("_known") >= 2)
    wanted = wanted.withColumn("_needed", F.concat("_known", demands))
    found = coverage.covering(wanted, "keyword", "_needed", docs, ordinal, haystack, classes)
    return coverage.first_documents(found, "keyword", ordinal, k)


def diagnose_feeds(entries: DataFrame, runs: DataFrame, feeds: DataFrame, now: Column) -> DataFrame:
    """JB11. Status of every feed: diagnosis, success streak and gate. Feeds have feed, source, enabled, retired, http,
    official and mime_ok; entries feed, ts, guid, canonical, relay; runs feed, run_ord, ok."""
    diag = aggregate.feed_diagnostic(entries, "feed", "ts", "guid", now)
    streak = windows.success_streak(runs, "feed", "run_ord", "ok")
    f = feeds.join(diag, "feed", "left").join(streak, "feed", "left").na.fill(0, ["items", "relay_ratio", "duplicate_guids"])
    status = rules.feed_status(F.col("retired"), F.col("enabled"), F.lit(True), F.col("http"), F.lit(True), F.col("age_days"), F.col("average_gap_days"), F.col("items"),
                               F.col("official"), F.col("relay_ratio"), F.col("duplicate_guids"), F.col("mime_ok"), F.col("consecutive_successes"))
    return f.withColumn("status", status)


def source_states(feed_status: DataFrame, sources: DataFrame) -> DataFrame:
    """JB11. Worst feed status per source."""
    return aggregate.worst_status(feed_status, sources, "source", "status")


def audit_images(site_items: DataFrame, url: str, base: Column) -> DataFrame:
    """JB12. Cleaned image per item, images shared by several items cleared, rights codes."""
    cleaned = site_items.withColumn("image_url", clean_image_url(F.col(url), base))
    keyed = cleaned.withColumn("_key", image_key(F.col("image_url")))
    return dedup.clear_repeated(keyed, "_key", "image_url").drop("_key").withColumn("image_codes", rules.image_issues())


def retention_guard(previous: DataFrame, current: DataFrame, allowed: DataFrame, key: str, declared: Column) -> DataFrame:
    """JB13. Findings (reason, n) of the snapshots and of removed keys that nobody allowed."""
    gone = setops.removed_keys(previous, current, allowed, key).where("verdict = 'unexpected'")
    lost = gone.agg(F.count("*").alias("n")).where("n > 0").select(F.lit("public-article-removed").alias("reason"), "n")
    return setops.union_sources(
        monitor.snapshot_issues(previous, [key], F.lit(None), "previous"), monitor.snapshot_issues(current, [key], declared, "current"), lost
    )


def extract_pages(site: DataFrame) -> DataFrame:
    """JB15. Identity, title, body and text verdict of every page."""
    out = site.select("page_id", "url", H.page_title(F.col("html")).alias("title"), H.extract_body(F.col("html")).alias("body"))
    return out.select(
        "page_id", normalize_url(F.col("url")).alias("normal_url"), stable_item_id([F.col("url")], [F.col("title")]).alias("item_id"), "title", "body",
        tx.article_text_quality(F.col("body"), F.col("title")).alias("verdict"),
    )
