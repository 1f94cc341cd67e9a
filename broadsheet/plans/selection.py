"""JB1, JB2, JB14: from collected entries to selected candidates and updates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CORRECTION_WORDS
from ..functions import text as tx
from ..functions.dates import age_days
from ..functions.patterns import matches, settle
from ..operators import dedup, filters, rules, similarity, topk, windows
from ..operators.setops import union_sources
from ..session import cut_lineage


def collect_candidates(direct: DataFrame, news: DataFrame, social: DataFrame, seen: DataFrame, segment: Column, limit: int | None = None) -> DataFrame:
    """JB1. Direct feeds, then news feeds drawn in turn, then social posts by score; duplicates and seen items go.

    Inputs have id, title, keys (array) and ord; news rows also feed and feed_ord, social rows also score. ``segment``
    cuts the order inside a news feed. Duplicates are judged in the order of collection; only the list of what is left has
    social posts by score. ``limit`` cuts that list before seen items go.
    """
    turns = windows.round_robin(news, "feed", "feed_ord", segment, [F.col("ord")])
    listed = union_sources(
        direct.withColumn("list_key", F.struct(F.lit(0).alias("part"), F.col("ord").cast("double").alias("a"), F.lit(0.0).alias("b"))),
        turns.drop("draw_key").withColumn("list_key", F.struct(F.lit(1).alias("part"), F.col("turn").cast("double").alias("a"), F.col("feed_ord").cast("double").alias("b"))),
        social.withColumn("list_key", F.struct(F.lit(2).alias("part"), F.col("ord").cast("double").alias("a"), F.lit(0.0).alias("b"))),
    )
    # The id breaks ties, so that the order is total.
    listed = listed.withColumn("list_key", F.struct("list_key.*", F.col("id").alias("c")))
    all_keys = F.array_distinct(F.concat("keys", F.array(F.concat(F.lit("t:"), tx.title_key(F.col("title"))))))
    unique = cut_lineage(dedup.keep_first_by_keys(listed, "id", "list_key", F.filter(all_keys, lambda k: k != "t:")))
    social_first = F.struct(F.col("list_key.part"), F.when(F.col("list_key.part") == 2, -F.col("score")).otherwise(F.col("list_key.a")).alias("a"), F.col("list_key.a").alias("b"), F.col("list_key.b").alias("d"), F.col("id"))
    unique = unique.withColumn("list_key", social_first)
    listed = unique if limit is None else unique.orderBy("list_key").limit(limit)
    return filters.drop_seen(listed, "id", F.col("keys"), seen, "key")


def score_and_split(candidates: DataFrame, score_fn: Callable[[DataFrame], DataFrame], row: str, url: str, tie: list[Column], deep_items: int, brief_items: int) -> DataFrame:
    """JB1. Deep and brief items by an outside scorer: ``score_fn`` returns (row, relevance) for the candidates it could
    score; the others count as 0."""
    scored = candidates.join(score_fn(candidates).select(row, "relevance"), row, "left")
    return topk.tier_split(scored, url, "relevance", tie, deep_items, brief_items)


def ingest(entries: DataFrame, status: DataFrame, seen: DataFrame, now: Column, limit: int, per_source: int, deep: int, terms: str | None = None) -> DataFrame:
    """JB2. Unique, relevant, unseen entries by score with a cap per source; the first ``deep`` are marked.

    Entries have id, ord, title, description, url_keys, source_id, published_at, has_canonical and priority; ``status`` is
    (id, status) of ``similarity.classify_entries``. Entries are scored first, so their texts stay out of the joins.
    """
    body = F.concat_ws(" ", "title", "description")
    relevant = tx.any_term(body, terms) if terms else tx.any_term(body)
    age = age_days(F.col("published_at"), now)
    score = topk.selection_score(age, F.col("description"), F.col("title"), F.col("has_canonical"), F.col("priority"))
    slim = settle(entries, _relevant=relevant, selection_score=score).where("_relevant").select("id", "ord", "source_id", "url_keys", "selection_score")
    unique = cut_lineage(slim.join(status.where("status = 'unique'").select("id"), "id", "left_semi"))
    fresh = cut_lineage(filters.drop_seen(unique, "id", F.col("url_keys"), seen, "key"))
    order = [F.col("selection_score").desc(), F.col("ord")]
    picked = windows.capped_pick(fresh, "source_id", order, per_source, limit)
    # Ranks follow the exact score; the shown one is rounded.
    return windows.mark_deep(picked, "id", order, deep).withColumn("selection_score", F.round("selection_score", 4))


def detect_updates(candidates: DataFrame, prior: DataFrame) -> DataFrame:
    """JB14, CL19. Best earlier article per candidate (similar title or same source URL) and the class of the update.

    Both have id, title, url (of the source), more_urls (raw and canonical ones; nulls and empty ones don't count) and body (all
    text fields, see ``update_text``); candidates also verified, prior also ord. Each text is read once, for its numbers (kept as
    one hash) and for words of correction. Equal titles of earlier articles are collapsed to the first one, so a hot title is one
    row.
    """
    def slim(df: DataFrame, *keep: str) -> DataFrame:
        words, numbers = F.array_sort(tx.title_tokens(F.col("title"))), F.sha2(F.array_join(tx.plain_numbers(F.col("body")), "|"), 256)
        urls = F.array_distinct(F.filter(F.concat(F.array("url"), "more_urls"), lambda u: F.coalesce(u, F.lit("")) != ""))
        return cut_lineage(df.select("id", F.coalesce("url", F.lit("")).alias("url"), *keep, words.alias("words"), numbers.alias("numbers"), urls.alias("urls"), matches(F.col("body"), CORRECTION_WORDS).alias("corrects")))

    cand, old = slim(candidates, "verified"), slim(prior, "ord")
    firsts = dedup.first_per_key(old.where(F.size("words") > 0), ["words"], [F.col("ord")])
    wanted = cand.where(F.size("words") > 0).groupBy("words").agg(F.min("id").alias("set_id"))
    best = similarity.best_similar(wanted, firsts, "set_id", "id", "ord", "words", 0.72)
    best = best.join(firsts.select(F.col("id").alias("right_id"), F.col("ord").alias("t_ord")), "right_id")
    set_match = wanted.join(best, wanted["set_id"] == best["left_id"]).select("words", F.col("right_id").alias("t_id"), F.col("similarity").alias("t_score"), "t_ord")
    by_url = dedup.first_per_key(old.where(F.col("url") != ""), ["url"], [F.col("ord")]).select("url", F.col("id").alias("u_id"), F.col("ord").alias("u_ord"))
    joined = cand.join(set_match, "words", "left").join(by_url, "url", "left")
    # A shared URL counts as a score of 1; among equals the earlier article in the list wins.
    use_url = F.col("u_id").isNotNull() & (F.col("t_id").isNull() | (F.col("t_score") < 1) | (F.col("u_ord") < F.col("t_ord")))
    joined = joined.withColumn("match_id", F.when(use_url, F.col("u_id")).otherwise(F.col("t_id")))
    p = old.select(F.col("id").alias("match_id"), F.col("words").alias("p_words"), F.col("urls").alias("p_urls"), F.col("numbers").alias("p_numbers"))
    full = joined.join(p, "match_id", "left")
    same_source = F.coalesce(F.arrays_overlap("urls", "p_urls"), F.lit(False))
    title_score = F.coalesce(tx.overlap_similarity(F.col("words"), F.col("p_words")), F.lit(0.0))
    return full.select(
        "id", "match_id", F.round(title_score, 3).alias("title_similarity"), same_source.alias("same_source"),
        rules.update_class(F.col("match_id").isNotNull(), F.col("verified"), same_source, F.col("numbers") == F.col("p_numbers"), F.round(title_score, 3), F.col("corrects")).alias("class"),
    )


def update_text(*fields: str) -> Column:
    """CL19. The text that updates are compared by: all text fields and paragraphs that are there, joined by blanks."""
    return F.concat_ws(" ", *[F.when(F.col(f) != "", F.col(f)) if f != "paragraphs" else F.col(f) for f in fields])
