"""JB3, JB4, JB10: repair, index build and daily release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DAILY_MINIMUM, DAILY_TARGET
from ..functions.patterns import settle
from ..functions.urls import image_key
from ..operators import aggregate, dedup, rules, topk, windows
from ..session import cut_lineage


def repair(items: DataFrame, row: str, key: str, order: list[Column], skip: tuple[str, ...] = ()) -> DataFrame:
    """JB3. Reasons to suppress each visible item: its own codes, or an earlier good copy of the same source. A bad copy
    does not claim the source.

    The codes are computed once and stored without the texts; the rest of the job moves only ids, keys and codes.
    """
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    visible = items.where(F.coalesce("visibility", F.lit("")) != "suppressed")
    coded = cut_lineage(visible.select(row, key, place.alias("_place"), rules.publish_issues(skip).alias("codes")))
    holders = coded.where((F.size("codes") == 0) & (F.col(key) != "")).groupBy(key).agg(F.min("_place").alias("_holder"))
    copy = F.coalesce(F.col("_holder") < F.col("_place"), F.lit(False))
    dup = F.when(copy, F.array(F.lit("duplicate-source"))).otherwise(F.array().cast("array<string>"))
    marked = coded.join(holders, key, "left").select(row, key, F.array_distinct(F.concat("codes", dup)).alias("reasons"))
    return marked.where(F.size("reasons") > 0)


def repair_report(repaired: DataFrame) -> DataFrame:
    """JB3. Suppressed items per reason."""
    return aggregate.histogram(repaired, "reasons", "reason")


def build_index(items: DataFrame, row: str, key: str, order: list[Column], keep: list[str], skip: tuple[str, ...] = ()) -> DataFrame:
    """JB4. Every page with title and body: repeated images cleared (counted over all items), later copies flagged, index
    decision made.

    The rules run once over the full rows; codes, keys and places go on as one narrow table, which copies and images are decided
    on, so no text is moved.
    """
    page = (F.col("title") != "") & (F.size("paragraphs") > 0)
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    coded = settle(items.withColumn("duplicate", F.lit(False)), publish_codes=F.when(page, rules.publish_issues(skip)))
    narrow = coded.select(
        *dict.fromkeys([row, key, *keep, "image_url"]), place.alias("_at"), page.alias("_page"), image_key(F.col("image_url")).alias("_image"), "publish_codes",
        rules.indexable(F.col("publish_codes")).alias("_fits"),
    )
    narrow = cut_lineage(narrow)
    pages = narrow.where("_page")
    copies = dedup.flag_later_copies(pages.select(row, key, "_at"), key, [F.col("_at")], "duplicate").select(row, "duplicate")
    images = dedup.clear_repeated(narrow.select(row, "image_url", "_image"), "_image", "image_url").select(row, "image_url")
    out = pages.select(row, *keep, "publish_codes", "_fits").join(copies, row).join(images, row)
    dup = F.when(F.col("duplicate"), F.array(F.lit("duplicate-source"))).otherwise(F.array().cast("array<string>"))
    return out.withColumns({"publish_codes": F.concat("publish_codes", dup), "indexable": F.col("_fits") & ~F.col("duplicate")}).drop("_fits")


def topic_hubs(indexed: DataFrame, topics: str, minimum: int = 5) -> DataFrame:
    """JB4. Topics with enough indexable articles."""
    return indexed.where("indexable").select(F.explode(topics).alias("topic")).groupBy("topic").agg(F.count("*").alias("n")).where(F.col("n") >= minimum)


def weeklies(items: DataFrame, day: str, order: list[Column], skip: tuple[str, ...] = ()) -> DataFrame:
    """JB4. Weekly digests of the items that can be shown."""
    shown = settle(items, _ok=rules.card_renderable(rules.quality_issues(skip))).where("_ok").drop("_ok")
    return topk.weekly_top(shown, day, order)


def evaluate_release(drafts: DataFrame, published: DataFrame, day: str, official: Column, order_by: Column, skip: tuple[str, ...] = ()) -> DataFrame:
    """JB10. Outcome of every draft of a day: already out today, out on another day, or the evaluation status.

    Drafts have id, ``day``, source_key and the item columns; an id counts once. Published items have id, ``day`` and
    source_key. The drafts are judged once, before any join, and go on without their texts.
    """
    judged = drafts.select("id", day, "source_key", "selection_score", order_by.alias("_order"), rules.release_evaluation(official, skip).alias("e"))
    once = cut_lineage(dedup.first_per_key(judged, ["id"], [F.col("_order")]))
    today_ids = published.select(F.col("id"), F.col(day), F.lit(True).alias("_id_today")).distinct()
    keyed = published.where(F.col("source_key") != "")
    today_keys = keyed.select(F.col("source_key"), F.col(day), F.lit(True).alias("_key_today")).distinct()
    # A key is out on another day if its first or its last day differs from the draft's day.
    days = keyed.groupBy("source_key").agg(F.min(day).alias("_first_day"), F.max(day).alias("_last_day"))
    rows = once.join(today_ids, ["id", day], "left").join(today_keys, ["source_key", day], "left").join(days, "source_key", "left")
    outcome = (
        F.when(F.coalesce("_id_today", "_key_today", F.lit(False)), F.lit("published-today"))
        .when((F.col("_first_day") != F.col(day)) | (F.col("_last_day") != F.col(day)), F.lit("published-before"))
        .otherwise(F.col("e.status"))
    )
    rows = rows.withColumn("outcome", outcome)
    ready = rows.where("outcome = 'ready-public-brief'")
    # The first ready draft of a source claims it.
    copies = dedup.flag_later_copies(ready.select("id", "source_key", "_order"), "source_key", [F.col("_order")], "_copy")
    later = copies.where("_copy").select("id", F.lit(True).alias("_later"))
    out = rows.join(later, "id", "left").withColumn("outcome", F.when(F.col("_later"), F.lit("published-before")).otherwise(F.col("outcome")))
    return out.drop("_id_today", "_key_today", "_first_day", "_last_day", "_later", "_order")


def release(evaluated: DataFrame, existing: DataFrame, day: str, tie: list[Column], target: int = DAILY_TARGET) -> tuple[DataFrame, DataFrame]:
    """JB10. The released drafts of each day up to the target, and the day's numbers with the minimum as a flag."""
    ready = evaluated.where("outcome = 'ready-public-brief'")
    order = topk.release_order(F.col("e.is_news"), F.col("e.index_candidate"), F.col("selection_score"), tie)
    picked, shortfall = windows.daily_fill(ready, existing, day, order, target)
    eligible = ready.groupBy(day).agg(F.count("*").alias("eligible"))
    have = existing.groupBy(day).agg(F.count("*").alias("existing"))
    report = shortfall.join(eligible, day, "left").join(have, day, "left").na.fill(0, ["eligible", "existing"])
    return picked, report.withColumn("minimum_reached", F.col("existing") + F.col("eligible") >= min(target, DAILY_MINIMUM))


def issue_rows_per_day(indexed: DataFrame, day: str, minimum: int = 4) -> DataFrame:
    """JB4. Edition pages with enough indexable items."""
    return indexed.groupBy(day).agg(F.count("*").alias("n_pages"), F.count_if("indexable").alias("n_index")).withColumn("page_indexable", F.col("n_index") >= minimum)


