"""CL29, CL30, CL34: freshness, manifest and snapshot checks over aggregated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_age, calendar_date
from ..functions.patterns import codes, text


def freshness(date_label: Column, today: Column, items: Column, declared: Column, max_age: int = 3, minimum: int = 0, require_today: bool = False) -> Column:
    """CL29. ``items`` is the actual number of items or null, ``declared`` the stated one or null."""
    age, n = calendar_age(date_label, today), F.coalesce(items, declared)
    strict = F.lit(require_today)
    return codes(
        (age.isNull(), "latest-date-invalid"),
        (age < 0, "latest-date-in-future"),
        ((age > 0) & strict, "latest-not-today"),
        ((age > max_age) & ~strict, "latest-stale"),
        (n.isNull(), "latest-items-invalid"),
        (n == 0, "latest-empty"),
        (items != declared, "latest-count-mismatch"),
        ((F.lit(minimum) > 0) & (n < minimum), "latest-below-minimum"),
    )


def search_payload(items: Column, declared: Column, without_key: Column) -> Column:
    """CL30. Search index: items, declared count and items without id or url."""
    return codes(
        (items.isNull(), "search-items-invalid"),
        (declared.isNull() | (declared < 0), "search-count-invalid"),
        (items != declared, "search-count-mismatch"),
        (without_key > 0, "search-item-key-missing"),
    )


def search_manifest(declared: Column, expected: Column, chunks: Column) -> Column:
    """CL30. Manifest of the search chunks."""
    return codes(
        (chunks.isNull(), "search-manifest-chunks-invalid"),
        (declared.isNull() | (declared < 0), "search-manifest-count-invalid"),
        (expected.isNotNull() & ~declared.eqNullSafe(expected), "search-manifest-count-mismatch"),
        ((declared > 0) & (chunks == 0), "search-manifest-empty"),
    )


def archive_payload(issues: Column, weeklies: Column) -> Column:
    """CL30."""
    return codes((issues.isNull(), "archive-issues-invalid"), (weeklies.isNull(), "archive-weeklies-invalid"), (issues == 0, "archive-empty"))


def deployment(version: Column, built_at: Column, latest: Column, commit: Column, counts: dict[str, Column]) -> Column:
    """CL30. Deployment record."""
    checks = [
        (~version.eqNullSafe(F.lit(1)), "deployment-version-invalid"),
        (built_at.isNull(), "deployment-built-at-invalid"),
        (calendar_date(text(latest)).isNull(), "deployment-latest-date-invalid"),
        (~F.regexp_like(text(commit), F.lit("(?i)^local$|^[0-9a-f]{7,64}$")), "deployment-source-commit-invalid"),
    ]
    checks += [(c.isNull() | (c < 0), f"deployment-{name}-invalid") for name, c in counts.items()]
    return codes(*checks)


def snapshot_issues(rows: DataFrame, key_columns: list[str], declared: Column, label: str) -> DataFrame:
    """CL34. Missing keys, duplicate keys and a wrong count of one snapshot, as (reason, n)."""
    key = F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in key_columns])
    per_key = rows.select(key.alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("actual"), F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)).alias("duplicates"),
    )
    findings = F.array_compact(
        F.array(
            F.when(F.col("missing") > 0, F.struct(F.lit(f"{label}-item-key-missing").alias("reason"), F.col("missing").alias("n"))),
            F.when(F.col("duplicates") > 0, F.struct(F.lit(f"{label}-duplicate-ids").alias("reason"), F.col("duplicates").alias("n"))),
            F.when(declared.isNotNull() & (declared != F.col("actual")), F.struct(F.lit(f"{label}-count-mismatch").alias("reason"), F.col("actual").alias("n"))),
        )
    )
    return totals.select(F.explode(findings).alias("f")).select("f.reason", "f.n")
