"""TK1-TK13: scores, orders and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import BRIEF_MIN_RELEVANCE, HANGUL, MIN_RELEVANCE, TOPIC_BODY_MIN_HITS, TOPICS
from ..functions.dates import iso_week
from ..functions.patterns import matches, needs_hangul, once, text
from ..functions.text import term_count, term_hits
from ..session import cut_lineage
from .dedup import first_per_key


def above_threshold(df: DataFrame, score: str, minimum: float, tie: list[Column], limit: int) -> DataFrame:
    """TK1."""
    return df.where(F.coalesce(score, F.lit(0)) >= minimum).orderBy(F.col(score).desc(), *tie).limit(limit)


def tier_split(df: DataFrame, url: str, score: str, tie: list[Column], deep_items: int, brief_items: int) -> DataFrame:
    """TK2. The best ``deep_items``, then ``brief_items`` briefs that are not already deep, marked by ``tier``."""
    value = F.coalesce(score, F.lit(0))
    deep = df.where(value >= MIN_RELEVANCE).orderBy(F.col(score).desc(), *tie).limit(deep_items)
    rest = df.where((value >= BRIEF_MIN_RELEVANCE) & (value < MIN_RELEVANCE)).join(deep.select(url), url, "left_anti")
    brief = rest.orderBy(F.col(score).desc(), *tie).limit(brief_items)
    return deep.withColumn("tier", F.lit("deep")).unionByName(brief.withColumn("tier", F.lit("brief")))


def selection_score(age_days: Column, description: Column, title: Column, has_canonical: Column, priority: Column) -> Column:
    """TK3. Recency, substance, relevance, canonical and trust, weighted."""
    recency = F.when(age_days.isNull(), F.lit(0.15)).otherwise(F.greatest(F.lit(0.0), 1 - F.abs(age_days) / 30))
    substance = F.least(F.lit(1.0), F.length(text(description)) / 600)
    relevance = F.least(F.lit(1.0), term_hits(F.concat_ws(" ", text(title), text(description))) / 4)
    trust = F.least(F.lit(1.0), F.coalesce(F.nullif(priority, F.lit(0)), F.lit(50)) / 100)
    canonical = F.when(has_canonical, 1.0).otherwise(0.0)
    return 0.40 * recency + 0.25 * substance + 0.20 * relevance + 0.10 * canonical + 0.05 * trust


# Feature sets up to this size are matched by their sub-sets, larger ones by single features.
MAX_SUBSET_FEATURES = 10


def _subsets(features: Column) -> Column:
    """All sub-sets of a sorted feature array as joined keys, the empty one included."""
    masks = F.sequence(F.lit(0), F.pow(F.lit(2), F.size(features)).cast("int") - 1)
    return F.transform(masks, lambda m: F.array_join(F.filter(features, lambda _, i: F.pmod((m / F.pow(F.lit(2), i)).cast("int"), F.lit(2)) == 1), "\u0001"))


def _points(shared: Column) -> Column:
    weight = lambda f: F.when(F.startswith(f, F.lit("e:")), 18).when(F.startswith(f, F.lit("t:")), 10).otherwise(3)
    return F.aggregate(shared, F.lit(0), lambda acc, f: acc + weight(f))


def related(items: DataFrame, item: str, topics: str, entities: str, category: str, eligible: str, ts: str, k: int = 5) -> DataFrame:
    """TK4. The ``k`` best related items: 10 per shared topic, 18 per shared entity, 3 for the category; newest first.

    No pairs of a topic are built. Items with the same features form a profile. For every sub-set of features only the
    ``k + 1`` newest items holding it are kept: an item that shares exactly this sub-set and is not among them is beaten by
    ``k`` newer items that share at least as much. So the candidates of a profile are the short lists of its sub-sets.
    """
    features = F.concat(
        F.transform(F.col(topics), lambda t: F.concat(F.lit("t:"), t)), F.transform(F.col(entities), lambda e: F.concat(F.lit("e:"), e)),
        F.array(F.concat(F.lit("c:"), F.coalesce(F.col(category), F.lit("")))),
    )
    keyed = items.select(F.col(item).alias("item"), F.col(ts).alias("ts"), F.col(eligible).alias("eligible"), F.array_sort(F.array_distinct(features)).alias("features"))
    # Topics usually come from a text; the features are stored, since three branches read them.
    keyed = cut_lineage(keyed.withColumn("profile", F.sha2(F.array_join("features", "\u0001"), 256)))
    newest = [F.col("ts").desc_nulls_last(), F.col("item")]

    def shortlist_by(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
        return df.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("place") <= k + 1).drop("place")

    pool = shortlist_by(keyed.where("eligible"), "profile", newest).select("item", "ts", F.col("features").alias("theirs"))
    profiles = keyed.select("profile", "features").dropDuplicates(["profile"])
    is_wide = lambda c: F.size(c) > MAX_SUBSET_FEATURES
    keys = lambda c: F.when(is_wide(c), F.array(F.lit(""))).otherwise(_subsets(F.col(c)))
    by_subset = shortlist_by(pool.withColumn("subset", F.explode(keys("theirs"))), "subset", newest)
    candidates = profiles.withColumn("subset", F.explode(keys("features"))).join(by_subset, "subset").drop("subset")
    # Feature sets too large for sub-sets meet their partners feature by feature.
    single_p, single_i = profiles.withColumn("f", F.explode("features")), pool.withColumn("f", F.explode("theirs"))
    wide = single_p.where(is_wide("features")).join(single_i, "f").unionByName(single_p.where(~is_wide("features")).join(single_i.where(is_wide("theirs")), "f"))
    candidates = candidates.unionByName(wide.drop("f")).dropDuplicates(["profile", "item"])
    scored = candidates.withColumn("score", _points(F.array_intersect("features", "theirs"))).select("profile", "item", "ts", "score")
    best = [F.col("score").desc(), F.col("ts").desc_nulls_last(), F.col("item")]
    own = keyed.select("profile", F.col("item").alias("current"))
    pairs = own.join(shortlist_by(scored, "profile", best), "profile").where(F.col("item") != F.col("current"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("current").orderBy(*best))).where(F.col("rank") <= k)
    return ranked.select(F.col("current").alias(item), "rank", F.col("item").alias("related"), "score")


def weekly_top(items: DataFrame, day: str, order: list[Column], k: int = 12, minimum: int = 3) -> DataFrame:
    """TK5. Best items of each ISO week; weeks with too few items are left out."""
    ranked = items.withColumn("week", iso_week(F.col(day)))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("week").orderBy(*order))).where(F.col("rank") <= k)
    full = ranked.groupBy("week").agg(F.count("*").alias("_n")).where(F.col("_n") >= minimum).select("week")
    return ranked.join(full, "week", "left_semi")


def recent_items(items: DataFrame, key: str, current_day: Column, day: str, category: str, preferred: DataFrame, order: list[Column], k: int = 6) -> DataFrame:
    """TK6. Newest items of other editions, one per source key, categories of the current edition first."""
    others = items.where(F.col(day) != current_day)
    unique = first_per_key(others.where(F.col(key) != ""), [key], order).unionByName(others.where(F.col(key) == ""))
    marks = preferred.select(F.col(category).alias("_cat"), F.lit(1).alias("_pref")).distinct()
    joined = unique.join(marks, unique[category] == marks["_cat"], "left").withColumn("preferred", F.coalesce("_pref", F.lit(0))).drop("_cat", "_pref")
    return joined.orderBy(F.col("preferred").desc(), *order).limit(k)


def release_order(is_news: Column, is_index: Column, score: Column, tie: list[Column]) -> list[Column]:
    """TK7."""
    return [is_news.desc(), is_index.desc(), F.coalesce(score, F.lit(0)).desc(), *tie]


def distinct_newest(items: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """TK8. Newest items, one per source key."""
    unique = first_per_key(items.where(F.col(key) != ""), [key], order).unionByName(items.where(F.col(key) == ""))
    return unique.orderBy(*order).limit(k)


def review_priority(risk: Column, status: Column, legacy_index: Column, re_review: Column) -> Column:
    """TK9."""
    base = F.when(risk == "high", 40).when(risk == "medium", 25).otherwise(10)
    return (
        base + F.when(status == "correction-required", 40).otherwise(0) + F.when(status == "vet-review-required", 20).otherwise(0)
        + F.when(legacy_index, 15).otherwise(0) + F.when(re_review, 15).otherwise(0)
    )


def low_ctr(rows: DataFrame, tie: list[Column], k: int = 100) -> DataFrame:
    """TK10. Often shown, hardly clicked."""
    hit = (F.coalesce("impressions", F.lit(0)) >= 20) & (F.coalesce("ctr", F.lit(0)) < 0.02)
    return rows.where(hit).orderBy(F.col("impressions").desc(), *tie).limit(k)


def near_top(rows: DataFrame, tie: list[Column], k: int = 100) -> DataFrame:
    """TK10. Average position 5 to 20."""
    return rows.where(F.col("position").between(5, 20)).orderBy(F.col("impressions").desc(), *tie).limit(k)


def schedule_score(risk: Column, tier: Column, source_status: Column, first_published: Column) -> Column:
    """TK11."""
    return (
        F.when(risk == "high", 40).when(risk == "medium", 25).otherwise(10) + F.when(tier == "evidence", 15).when(tier == "analysis", 10).otherwise(0)
        + F.when(source_status == "verified", 10).otherwise(0) + F.when(first_published.isNull(), 5).otherwise(0)
    )


def packet(queues: list[DataFrame], k: int = 10) -> DataFrame:
    """TK12. Best rows over several scored queues (id, type, score); an id counts once, with its best score."""
    rows = queues[0]
    for q in queues[1:]:
        rows = rows.unionByName(q)
    best = first_per_key(rows, ["id"], [F.col("score").desc(), F.col("queue_ord")])
    return best.orderBy(F.col("score").desc(), "id").limit(k)


def topic_hits(meta: Column, body: Column, topics=TOPICS) -> Column:
    """Hits of every topic in title and body, as one array; the dictionary is part of the expression. Topics in Hangul are only
    counted in texts that have any."""
    def hits(found: Column) -> Column:
        count = lambda value, match, there: F.when(there, term_count(value, match)).otherwise(F.lit(0)) if needs_hangul(match) else term_count(value, match)
        return F.array(
            *[
                F.struct(F.lit(i).alias("ord"), F.lit(slug).alias("slug"), count(meta, match, found["meta"]).alias("meta"), count(body, match, found["body"]).alias("body"))
                for i, (slug, match) in enumerate(topics)
            ]
        )

    return once(F.struct(matches(meta, HANGUL).alias("meta"), matches(body, HANGUL).alias("body")), hits)


def best_topics(hits: Column) -> Column:
    """TK13, CL6. Up to three topics by title hits, else the best body topic with enough hits."""
    strong = F.filter(hits, lambda h: h["meta"] > 0)
    ranked = F.array_sort(F.transform(strong, lambda h: F.struct((-h["meta"]).alias("m"), (-h["body"]).alias("b"), h["ord"].alias("o"), h["slug"].alias("slug"))))
    weak = F.filter(hits, lambda h: h["body"] >= TOPIC_BODY_MIN_HITS)
    best_weak = F.array_sort(F.transform(weak, lambda h: F.struct((-h["body"]).alias("b"), h["ord"].alias("o"), h["slug"].alias("slug"))))
    return F.when(F.size(strong) > 0, F.transform(F.slice(ranked, 1, 3), lambda h: h["slug"])).otherwise(
        F.transform(F.slice(best_weak, 1, 1), lambda h: h["slug"])
    )


def main_topic(value: Column, topics=TOPICS) -> Column:
    """JB9. The topic with the most hits in a text, the first of equals; null without a hit."""
    hits = F.filter(topic_hits(value, F.lit(""), topics), lambda h: h["meta"] > 0)
    return F.get(F.array_sort(F.transform(hits, lambda h: F.struct((-h["meta"]).alias("m"), h["ord"].alias("o"), h["slug"].alias("slug")))), F.lit(0))["slug"]
