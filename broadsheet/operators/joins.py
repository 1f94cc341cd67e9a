"""JN1-JN15 without the similarity joins and keyword coverage. No broadcast hints: Spark checks the size of a side itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import host_of, host_suffixes
from .dedup import first_per_key


def attach_scores(df: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """JN1. Scores onto rows by id."""
    return df.join(scores, key, "left")


def attach_dimension(df: DataFrame, dim: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """JN2. Dimension attributes; a small dimension is broadcast by the planner."""
    return df.join(dim, df[left_key] == dim[right_key], "left")


def having_any_key(df: DataFrame, row: str, keys: Column, known: DataFrame, key: str) -> DataFrame:
    """JN3. Rows with at least one known key, each once."""
    hits = df.select(row, F.explode(keys).alias(key)).join(known, key, "left_semi").select(row).distinct()
    return df.join(hits, row, "left_semi")


def having_no_key(df: DataFrame, row: str, keys: Column, known: DataFrame, key: str) -> DataFrame:
    """JN4. Rows with none of the known keys."""
    hits = df.select(row, F.explode(keys).alias(key)).join(known, key, "left_semi").select(row).distinct()
    return df.join(hits, row, "left_anti")


def match_domain(df: DataFrame, url: str, domains: DataFrame, domain: str, row: str) -> DataFrame:
    """JN5. The most specific registry domain that is the host or above it."""
    suffixes = df.select(row, F.explode(host_suffixes(host_of(F.col(url)))).alias(domain)).where(F.col(domain) != "")
    hits = suffixes.join(domains, domain).withColumn("_len", F.length(domain))
    best = first_per_key(hits, [row], [F.col("_len").desc(), F.col(domain)]).drop("_len")
    return df.join(best, row, "left")


def band_join(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str, days: int) -> DataFrame:
    """JN7. Same key and at most ``days`` apart: dates fall into bands, each left row meets its own and the two next."""
    width = days + 1
    band = lambda c: F.floor(F.unix_date(F.col(c)) / F.lit(width))
    l = left.withColumn("_band", F.explode(F.array(band(left_day) - 1, band(left_day), band(left_day) + 1)))
    r = right.withColumn("_band", band(right_day)).withColumnRenamed(key, "_key")
    on = (l[key] == r["_key"]) & (l["_band"] == r["_band"]) & (F.abs(F.date_diff(l[left_day], r[right_day])) <= days)
    return l.join(r, on).drop("_key", "_band")


def attach_by_id_or_title(tasks: DataFrame, articles: DataFrame, fields: list[str]) -> DataFrame:
    """JN8. Article by id; failing that, the last article with the same date and title."""
    by_id = articles.select(F.col("article_id").alias("_id"), F.struct(*fields).alias("_by_id"))
    by_title = articles.groupBy("article_date", "article_title").agg(F.max_by(F.struct(*fields), "article_ord").alias("_by_title"))
    out = tasks.join(by_id, tasks["task_article_id"] == by_id["_id"], "left").drop("_id")
    on = out["task_date"].eqNullSafe(by_title["article_date"]) & out["task_title"].eqNullSafe(by_title["article_title"])
    out = out.join(by_title, on, "left").drop("article_date", "article_title")
    return out.withColumn("article", F.coalesce("_by_id", "_by_title")).drop("_by_id", "_by_title")


def snapshot_diff(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """JN11. Each key as added, removed or kept."""
    p = previous.select(F.col(key).alias("_p")).distinct()
    c = current.select(F.col(key).alias("_c")).distinct()
    joined = p.join(c, F.col("_p") == F.col("_c"), "full_outer")
    change = F.when(F.col("_p").isNull(), "added").when(F.col("_c").isNull(), "removed").otherwise("kept")
    return joined.select(F.coalesce("_p", "_c").alias(key), change.alias("change"))


def broken_links(edges: DataFrame, target: str, pages: DataFrame, page_path: str) -> DataFrame:
    """JN12. Internal links without a target page."""
    internal = edges.where(
        F.startswith(target, F.lit("/")) & ~F.startswith(target, F.lit("//")) & ~F.startswith(target, F.lit("/api/")) & ~F.startswith(target, F.lit("/search"))
    ).withColumn("target_path", F.regexp_replace(target, "[?#].*$", ""))
    known = pages.select(F.col(page_path).alias("target_path")).distinct()
    return internal.join(known, "target_path", "left_anti")


def sitemap_issues(urls: DataFrame, loc: str, pages: DataFrame) -> DataFrame:
    """JN13. Sitemap entries against pages (url, robots, canonical), with reason codes."""
    joined = urls.join(pages, urls[loc] == pages["page_url"], "left")
    missing = F.col("page_url").isNull()
    reasons = F.array_compact(
        F.array(
            F.when(missing, F.lit("target-missing")),
            F.when(~missing & F.contains("robots", F.lit("noindex")), F.lit("noindex-listed")),
            F.when(~missing & ~F.col("canonical").eqNullSafe(F.col(loc)), F.lit("canonical-mismatch")),
        )
    )
    return joined.withColumn("reasons", reasons)


def latest_state(df: DataFrame, events: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """JN15. Latest event of each key onto the rows."""
    return df.join(first_per_key(events, [key], order), key, "left")


def top_per_key(df: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """Best ``k`` rows per key; Spark limits each key before the shuffle."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)
