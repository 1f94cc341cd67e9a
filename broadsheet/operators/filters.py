"""FL1-FL11: row predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BRIEF_MIN_CHARS, KEYWORD_CONTEXT, PAYWALL
from ..functions.dates import parse_timestamp
from ..functions.patterns import matches, text


def social_rule(over18: Column, stickied: Column, is_self: Column, score: Column, body: Column, min_score) -> Column:
    """FL1."""
    return ~over18 & ~stickied & is_self & (score >= min_score) & (F.length(body) >= 100)


def recent_enough(raw_date: Column, now: Column, max_age_days: int) -> Column:
    """FL2. No date passes, an unreadable date does not."""
    ts = parse_timestamp(raw_date)
    missing = text(raw_date) == ""
    return missing | F.coalesce(ts >= now - F.make_interval(days=F.lit(max_age_days)), F.lit(False))


def not_paywalled(body: Column) -> Column:
    """FL3."""
    return ~matches(text(body), PAYWALL)


def recent_window(df: DataFrame, ts: str, now: Column, max_age_days: int, limit: int, tie: list[Column]) -> DataFrame:
    """FL4. Rows of the last days, none from the future, newest first."""
    since = now - F.make_interval(days=F.lit(max_age_days))
    return df.where((F.col(ts) >= since) & (F.col(ts) <= now)).orderBy(F.col(ts).desc(), *tie).limit(limit)


def visible(visibility: Column, scheduled_at: Column, now: Column) -> Column:
    """FL5. Neither suppressed nor scheduled for later."""
    return (text(visibility) != "suppressed") & (scheduled_at.isNull() | (scheduled_at <= now))


def queue_filter(task_type: str, bucket: str, query: str) -> Column:
    """FL6. Filter over work-queue columns: type, priority bucket and free text."""
    cond = F.lit(True)
    if task_type and task_type != "all":
        cond = cond & (F.col("type") == task_type)
    if bucket and bucket != "all":
        cond = cond & (priority_bucket(F.col("priority")) == bucket)
    needle = query.strip().lower()
    if needle:
        fields = ["id", "type", "label", "title", "reason", "source_label", "article_id"]
        hit = F.lit(False)
        for name in fields:
            hit = hit | F.contains(F.lower(text(F.col(name))), F.lit(needle))
        cond = cond & (hit | F.exists("evidence", lambda e: F.contains(F.lower(e), F.lit(needle))))
    return cond


def priority_bucket(priority: Column) -> Column:
    return F.when(priority >= 130, "critical").when(priority >= 90, "high").otherwise("normal")


def drop_seen(df: DataFrame, row: str, keys: Column, seen: DataFrame, seen_key: str) -> DataFrame:
    """FL7. Drop rows with any key already seen."""
    claims = df.select(F.col(row), F.explode(keys).alias(seen_key))
    known = claims.join(seen.select(seen_key), seen_key, "left_semi").select(row).distinct()
    return df.join(known, row, "left_anti")


def needs_backfill(cols: dict[str, Column]) -> Column:
    """FL8. Verified unique brief of low or medium risk whose text is missing or too short."""
    return (
        (text(cols["workflow_status"]) != "published")
        & (F.lower(F.coalesce(cols["content_tier"], F.lit(""))) == "brief")
        & (F.lower(text(cols["clinical_risk"])) != "high")
        & (text(cols["source_status"]) == "verified")
        & (text(cols["duplicate_status"]) == "unique")
        & (text(cols["source_key"]) != "")
        & ((cols["body_chars"] < BRIEF_MIN_CHARS) | (text(cols["title"]) == "") | (text(cols["lead"]) == ""))
    )


def enabled_sources(df: DataFrame, wanted: str | None = None) -> DataFrame:
    """FL9."""
    active = df.where(F.col("enabled"))
    return active.where((F.col("id") == wanted) | (F.col("label") == wanted)) if wanted else active


def keyword_in_context(keyword: Column, pattern: str = KEYWORD_CONTEXT) -> Column:
    """FL10."""
    return matches(keyword, pattern)


def search(df: DataFrame, query: str, fields: list[Column], category: str | None, read_ids: DataFrame | None, row: str) -> DataFrame:
    """FL11. Substring search over the joined fields, optionally one category and unread rows only."""
    out = df if not category or category == "all" else df.where(F.col("category") == category)
    needle = query.strip().lower()
    if needle:
        out = out.where(F.contains(F.lower(F.concat_ws(" ", *fields)), F.lit(needle)))
    return out.join(read_ids, row, "left_anti") if read_ids is not None else out
