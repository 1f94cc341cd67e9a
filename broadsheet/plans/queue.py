"""JB8, CL37, CL41, CL43: work queue, draft enrichment, review packets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import settle
from ..operators import aggregate, filters, joins, rules, tasks
from ..operators.setops import queue_order, union_tasks


def work_queue(review: DataFrame, sources: DataFrame, images: DataFrame, feeds: DataFrame, drafts: DataFrame, findings: DataFrame, corrections: DataFrame) -> DataFrame:
    """JB8. All open tasks. Sources find their article by id, else by date and title."""
    arts = review.select(
        F.col("id").alias("article_id"), F.col("date").alias("article_date"), F.col("title").alias("article_title"), F.col("id").alias("article_ord"),
        "indexable", F.col("title").alias("found_title"),
    )
    named = sources.withColumns({"task_article_id": F.col("article_id"), "task_date": F.col("date"), "task_title": F.col("title")}).drop("indexable")
    placed = joins.attach_by_id_or_title(named, arts.select("article_id", "article_date", "article_title", "article_ord", "indexable", "found_title"), ["indexable", "found_title"])
    placed = placed.withColumns({"indexable": F.col("article.indexable"), "article_title": F.col("article.found_title")})
    return union_tasks(
        tasks.production_tasks(findings), tasks.editorial_tasks(review), tasks.source_tasks(placed), tasks.image_tasks(images), tasks.feed_tasks(feeds),
        tasks.draft_tasks(drafts), tasks.correction_tasks(corrections),
    )


def queue_head(queue: DataFrame, k: int = 10) -> DataFrame:
    return queue.orderBy(*queue_order()).limit(k)


def queue_report(queue: DataFrame) -> DataFrame:
    return aggregate.queue_counts(queue, filters.priority_bucket(F.col("priority")))


def enrich_drafts(drafts: DataFrame, claims: DataFrame, language: DataFrame) -> DataFrame:
    """CL41. Audit warnings onto drafts (id, clinical_risk); the audits are (id, warnings)."""
    none = F.array().cast("array<string>")
    joined = drafts.join(claims.select("id", F.col("warnings").alias("_c")), "id", "left").join(language.select("id", F.col("warnings").alias("_l")), "id", "left")
    priority = F.when(F.col("clinical_risk") == "high", 100).when(F.col("clinical_risk") == "medium", 70).otherwise(40)
    return joined.withColumns({"warnings": F.concat(F.coalesce("_c", none), F.coalesce("_l", none)), "priority": priority}).drop("_c", "_l")


def review_packets(items: DataFrame, index_ids: DataFrame, priority: Column) -> DataFrame:
    """CL43. Indexed items of medium or high risk with source, research fields and numeric warnings."""
    indexed = items.join(index_ids.select("id").distinct(), "id", "left_semi")
    risky = settle(indexed, risk=rules.clinical_risk()).where(F.col("risk").isin("medium", "high"))
    source = F.struct(F.col("source_label").alias("label"), F.col("source_url").alias("url"), F.coalesce("source_status", F.when(F.col("source_url").isNotNull(), F.lit("ok")).otherwise(F.lit("unresolved"))).alias("status"))
    research = F.struct("study_type", "species_studied", "sample_size", "limitations", "doi")
    return risky.select("id", "date", "title", "risk", "workflow_status", source.alias("source"), research.alias("research"), rules.item_numeric_issues().alias("numeric_codes"), priority.alias("priority"))


