"""SC11, SC12: the source registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import strip, text
from ..functions.urls import host_of, is_relay, source_id

_NONE = "array<string>"


def clean_domains(domains: Column) -> Column:
    bare = F.transform(F.coalesce(domains, F.array().cast(_NONE)), lambda d: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(d), "^https?://", ""), r"^www\.", ""), "/.*$", ""))
    return F.array_distinct(F.filter(bare, lambda d: d != ""))


def _set(col: Column) -> Column:
    return F.array_distinct(F.filter(F.coalesce(col, F.array().cast(_NONE)), lambda x: x != ""))


def normalize_registry(rows: DataFrame) -> DataFrame:
    """SC11. Defaults, clean domains and bounded limits. Reads id, label, domains, rss_urls, atom_urls, enabled,
    rate_limit_ms, timeout_ms, priority, consecutive_failures, health_status."""
    label = strip(text(F.col("label")))
    base = rows.withColumns({"label": label, "domains": clean_domains(F.col("domains")), "rss_urls": _set(F.col("rss_urls")), "atom_urls": _set(F.col("atom_urls"))})
    feeds = F.size("rss_urls") + F.size("atom_urls") > 0
    base = base.withColumn("enabled", F.coalesce("enabled", (F.size("domains") > 0) & feeds))
    return base.withColumns(
        {
            "id": F.coalesce(F.nullif("id", F.lit("")), source_id(F.col("label"))),
            "fetch_strategy": F.when(feeds, F.lit("rss")).otherwise(F.lit("manual")),
            "rate_limit_ms": F.greatest(F.lit(250), F.coalesce(F.nullif("rate_limit_ms", F.lit(0)), F.lit(1000))),
            "timeout_ms": F.least(F.lit(60000), F.greatest(F.lit(3000), F.coalesce(F.nullif("timeout_ms", F.lit(0)), F.lit(12000)))),
            "priority": F.coalesce("priority", F.when(F.col("enabled"), 50).otherwise(0)),
            "consecutive_failures": F.coalesce("consecutive_failures", F.lit(0)),
            "health_status": F.coalesce(F.nullif("health_status", F.lit("")), F.when(F.col("enabled"), F.lit("unknown")).otherwise(F.lit("disabled"))),
        }
    )


def build_registry(items: DataFrame, mapping: DataFrame, excluded_hosts: tuple[str, ...] = ()) -> DataFrame:
    """SC12. (label, domain, configured, priority, enabled) for all labels of the items and of the mapping.

    The long form keeps a publisher with many hosts from becoming one huge row.
    """
    url = F.coalesce(F.nullif("source_url_raw", F.lit("")), F.col("source_url"))
    hosts = items.where(text(F.col("source_label")) != "").select(F.col("source_label").alias("label"), F.when((text(url) != "") & ~is_relay(url), host_of(url)).alias("domain"))
    hosts = hosts.withColumn("domain", F.when((F.col("domain") != "") & ~F.col("domain").isin(*excluded_hosts), F.col("domain")) if excluded_hosts else F.nullif("domain", F.lit("")))
    direct = hosts.distinct()
    configured = mapping.select("label", F.explode_outer("domains").alias("domain"), F.lit(True).alias("configured"))
    rows = direct.withColumn("configured", F.lit(False)).unionByName(configured).groupBy("label", "domain").agg(F.bool_or("configured").alias("configured"))
    active = rows.groupBy("label").agg((F.count("domain") > 0).alias("enabled"))
    listed = rows.join(active, "label").where(F.col("domain").isNotNull() | ~F.col("enabled"))
    return listed.withColumns({"id": source_id(F.col("label")), "priority": F.when(F.col("enabled"), 50).otherwise(0)})
