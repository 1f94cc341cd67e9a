"""CL37, JB8: work tasks. One select per kind of task, then one union in queue order.

Every builder returns the columns of ``TASK``; ``union_tasks`` puts them together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import codes, settle, text

TASK = ("id", "type", "label", "priority", "article_id", "title", "indexable", "risk", "required_role", "blocker", "reason", "source_label", "evidence")


def _task(df: DataFrame, **cols: Column) -> DataFrame:
    defaults = {
        "article_id": F.lit(None).cast("string"), "indexable": F.lit(False), "risk": F.lit(None).cast("string"), "required_role": F.lit("editor"),
        "source_label": F.lit(None).cast("string"), "evidence": F.array().cast("array<string>"),
    }
    values = {**defaults, **cols}
    return df.select(*[values[name].alias(name) for name in TASK])


def _or(col: Column, fallback) -> Column:
    return F.coalesce(F.nullif(col, F.lit("")), fallback if isinstance(fallback, Column) else F.lit(fallback))


def editorial_tasks(review: DataFrame) -> DataFrame:
    """Corrections and reviews that wait. Reads id, title, indexable, clinical_risk, reviewer_needed, workflow_status,
    re_review and the three arrays of issues."""
    correction = (
        (text(F.col("workflow_status")) == "correction-required") | F.array_contains("review_codes", "correction-required")
        | F.array_contains("quality_codes", "correction-required")
    )
    high, medium = F.col("clinical_risk") == "high", F.col("clinical_risk") == "medium"
    high, medium = F.coalesce(high, F.lit(False)), F.coalesce(medium, F.lit(False))
    needed = F.col("reviewer_needed") & F.col("indexable") & (high | medium)
    numeric = F.size("numeric_codes") > 0
    rows = settle(review, _open=correction | needed | F.col("re_review") | numeric).where("_open")
    reasons = F.concat(
        codes((correction, "correction"), (high, "high risk"), (medium, "medium risk"), (needed, "no reviewer"), (F.col("re_review"), "text changed")),
        F.col("numeric_codes"),
    )
    return _task(
        rows, id=F.concat(F.lit("editorial:"), "id"), type=F.when(correction, F.lit("correction")).otherwise(F.lit("editorial-review")),
        label=F.when(correction, F.lit("correction")).otherwise(F.lit("review")),
        priority=F.when(correction, 140).when(high, 115).when(medium, 95).otherwise(85), article_id=F.col("id"), title=_or(F.col("title"), "untitled"),
        indexable=F.col("indexable"), risk=_or(F.col("clinical_risk"), "unknown"),
        required_role=F.when(high | (medium & (text(F.col("reviewer_role")) != "editor")), F.lit("vet")).otherwise(F.lit("editor")),
        blocker=F.when(correction, F.lit("correction-required")).otherwise(F.lit("review-required")), reason=F.array_join(reasons, " · "),
        evidence=F.concat("quality_codes", "review_codes", "numeric_codes"),
    )


def source_tasks(rows: DataFrame) -> DataFrame:
    """Unresolved sources. Reads article_id, status, source_label, title, article_title, indexable."""
    open_rows = rows.where(F.col("status").isin("unresolved", "candidate", "rejected"))
    flagged = F.coalesce("indexable", F.lit(False))
    return _task(
        open_rows, id=F.concat(F.lit("source:"), "article_id"), type=F.lit("source-review"), label=F.lit("source"), priority=F.when(flagged, 125).otherwise(75),
        article_id=F.col("article_id"), title=_or(F.col("article_title"), _or(F.col("title"), "untitled")), indexable=flagged, blocker=F.lit("source-unresolved"),
        reason=F.concat(F.when(F.col("status") == "candidate", "check candidate").when(F.col("status") == "rejected", "judge again").otherwise("no official URL"), F.lit(" · "), _or(F.col("source_label"), "unknown source")),
        source_label=F.col("source_label"),
    )


def image_tasks(queue: DataFrame) -> DataFrame:
    """Images without settled rights. Reads id, title, status, indexable, issues."""
    pending = queue.where(F.col("status") == "pending")
    return _task(
        pending, id=F.concat(F.lit("image:"), "id"), type=F.lit("image-rights"), label=F.lit("image"), priority=F.when(F.col("indexable"), 105).otherwise(45),
        article_id=F.col("id"), title=_or(F.col("title"), "untitled"), indexable=F.col("indexable"), blocker=F.lit("image-rights-unknown"),
        reason=_or(F.array_join("issues", ", "), "no proof of rights"), evidence=F.col("issues"),
    )


def feed_tasks(feeds: DataFrame) -> DataFrame:
    """Feeds to repair. Reads source_id, source_label, status, http_status."""
    broken = feeds.where(F.col("status").isin("failing", "degraded", "stale"))
    return _task(
        broken, id=F.concat(F.lit("feed:"), "source_id"), type=F.lit("feed-health"), label=F.lit("feed"),
        priority=F.when(F.col("status") == "failing", 90).when(F.col("status") == "stale", 65).otherwise(55), title=_or(F.col("source_label"), "feed"),
        blocker=F.lit("feed-health"), reason=F.col("status"), source_label=F.col("source_label"),
        evidence=F.array(F.coalesce(F.concat(F.lit("HTTP "), F.col("http_status").cast("string")), F.lit("HTTP unknown"))),
    )


def draft_tasks(drafts: DataFrame) -> DataFrame:
    """Drafts to judge. Reads id, title, clinical_risk, published, source_label, warnings."""
    risk = _or(F.col("clinical_risk"), "low")
    return _task(
        drafts.where(~F.coalesce("published", F.lit(False))), id=F.concat(F.lit("draft:"), "id"), type=F.lit("draft-review"), label=F.lit("draft"),
        priority=F.when(risk == "high", 100).when(risk == "medium", 80).otherwise(50), article_id=F.col("id"), title=_or(F.col("title"), "untitled"), risk=risk,
        blocker=F.lit("draft-not-approved"), reason=F.concat(risk, F.lit("-risk draft")), source_label=F.col("source_label"), evidence=F.col("warnings"),
    )


def production_tasks(findings: DataFrame) -> DataFrame:
    """One task for all findings of the production checks. Reads severity and reason."""
    counted = findings.agg(F.count_if(F.col("severity") == "critical").alias("c"), F.count_if(F.col("severity") == "warning").alias("w"))
    critical = F.col("c") > 0
    return _task(
        counted.where((F.col("c") > 0) | (F.col("w") > 0)), id=F.lit("production:sync"), type=F.lit("production-sync"), label=F.lit("production"),
        priority=F.when(critical, 150).otherwise(60), title=F.lit("production"), blocker=F.when(critical, F.lit("production-critical")).otherwise(F.lit("production-warning")),
        reason=F.when(critical, F.concat(F.col("c").cast("string"), F.lit(" critical"))).otherwise(F.concat(F.col("w").cast("string"), F.lit(" warnings"))),
    )


def correction_tasks(rows: DataFrame) -> DataFrame:
    """Open reader corrections. Reads id, kind, status, message."""
    status = F.lower(_or(F.col("status"), "open"))
    kind = _or(F.col("kind"), "other")
    open_rows = rows.where(~status.isin("resolved", "closed", "rejected") & (text(F.col("id")) != ""))
    return _task(
        open_rows, id=F.concat(F.lit("public-correction:"), "id"), type=F.lit("correction"), label=F.lit("reader correction"),
        priority=F.when(kind.isin("fact", "copyright", "deletion"), 145).otherwise(135), title=F.concat(F.lit("correction · "), kind),
        blocker=F.lit("public-correction-open"), reason=status, source_label=F.lit("public-report-form"), evidence=F.array(_or(F.col("message"), "no message")),
    )
