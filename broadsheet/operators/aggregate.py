"""AG1-AG20: aggregations. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import segments
from .dedup import first_per_key


def quality_report(items: DataFrame, dims: list[str], flags: str) -> DataFrame:
    """AG1. Counts by each dimension in one grouping-sets pass, plus counts by flag; flags are exploded apart from the
    row counts, so that rows are not multiplied."""
    sets = [[F.col(d)] for d in dims] + [[]]
    grouped = items.groupingSets(sets, *[F.col(d) for d in dims]).agg(
        F.grouping_id().alias("gid"),
        F.count("*").alias("raw"),
        F.count_if(F.col("public")).alias("public"),
        F.count_if(F.col("suppressed")).alias("suppressed"),
        F.count_if(F.col("image_url").isNotNull()).alias("with_image"),
    )
    full = (1 << len(dims)) - 1
    which = F.lit("total")
    for i, d in enumerate(dims):
        which = F.when(F.col("gid") == full - (1 << (len(dims) - 1 - i)), F.lit(d)).otherwise(which)
    label = F.coalesce(*[F.col(d).cast("string") for d in dims], F.lit("all"))
    report = grouped.select(which.alias("dimension"), F.when(which == "total", "all").otherwise(label).alias("value"), "raw", "public", "suppressed", "with_image")
    by_flag = items.select("public", "suppressed", "image_url", F.explode(flags).alias("flag")).groupBy("flag").agg(
        F.count("*").alias("raw"), F.count_if(F.col("public")).alias("public"), F.count_if(F.col("suppressed")).alias("suppressed"),
        F.count_if(F.col("image_url").isNotNull()).alias("with_image"),
    )
    return report.unionByName(by_flag.select(F.lit("flag").alias("dimension"), F.col("flag").alias("value"), "raw", "public", "suppressed", "with_image"))


def count_by(df: DataFrame, key: Column, name: str = "value") -> DataFrame:
    """AG2."""
    return df.groupBy(F.coalesce(F.nullif(key, F.lit("")), F.lit("unclassified")).alias(name)).agg(F.count("*").alias("n"))


def performance_groups(rows: DataFrame, dims: list[str]) -> DataFrame:
    """AG4. Impressions, clicks and click rate by every dimension on its own."""
    sets = [[F.col(d)] for d in dims]
    grouped = rows.groupingSets(sets, *[F.col(d) for d in dims]).agg(
        F.grouping_id().alias("gid"), F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"), F.count("*").alias("n_rows")
    )
    full = (1 << len(dims)) - 1
    which, label = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, d in enumerate(dims):
        mine = F.col("gid") == full - (1 << (len(dims) - 1 - i))
        which = F.when(mine, F.lit(d)).otherwise(which)
        label = F.when(mine, F.col(d).cast("string")).otherwise(label)
    return grouped.select(
        which.alias("dimension"), F.coalesce(F.nullif(label, F.lit("")), F.lit("unclassified")).alias("value"), "impressions", "clicks", "n_rows",
        (F.col("clicks") / F.greatest(F.lit(1), F.col("impressions"))).alias("ctr"),
    )


def keyword_max(df: DataFrame, keyword: str, volume: str, tie: str) -> DataFrame:
    """AG5. Row with the largest volume per keyword; the first of equals stays."""
    return first_per_key(df, [keyword], [F.col(volume).desc(), F.col(tie)])


def market_health(feeds: DataFrame) -> DataFrame:
    """AG6. Health per market with roll-ups per group and overall."""
    return feeds.rollup("feed_group", "market").agg(
        F.grouping_id().alias("level"),
        F.count("*").alias("total"), F.count_if("ok").alias("ok"), F.sum("items").alias("items"),
        F.count_if(~F.col("ok")).alias("failed"), F.count_if("stale").alias("stale"),
    )


def source_directory(items: DataFrame, source: str, order: list[Column], title: str, country: str, top: int = 3) -> DataFrame:
    """AG7. Items per source with its newest titles; only the top rows of a source are gathered."""
    base = items.where(F.trim(source) != "").withColumn("_source", F.trim(source))
    totals = base.groupBy("_source").agg(F.count("*").alias("n_items"), F.countDistinct(country).alias("n_countries"))
    ranked = base.withColumn("_rn", F.row_number().over(Window.partitionBy("_source").orderBy(*order))).where(F.col("_rn") <= top)
    newest = ranked.groupBy("_source").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", F.col(title).alias("t")))), lambda x: x["t"]).alias("newest")
    )
    return totals.join(newest, "_source").withColumnRenamed("_source", "source")


def queue_counts(tasks: DataFrame, bucket: Column) -> DataFrame:
    """AG8."""
    buckets = ["critical", "high", "normal"]
    return tasks.withColumn("_bucket", bucket).groupBy("type").pivot("_bucket", buckets).count().na.fill(0, buckets)


def upper_median(df: DataFrame, keys: list[str], value: str, segment: Column, name: str) -> DataFrame:
    """AG9, AG19. Element at index ``floor(n / 2)`` of the ascending values."""
    return segments.value_at(df, keys, value, F.floor(F.col("n") / 2), segment, name)


def histogram(df: DataFrame, codes: str, name: str = "code") -> DataFrame:
    """AG10, AG13, AG14. Rows per code of an array column."""
    return df.select(F.explode(codes).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def feed_diagnostic(entries: DataFrame, feed: str, ts: str, guid: str, now: Column) -> DataFrame:
    """AG11. Items, newest, age, average gap, coverage ratios and repeated ids per feed.

    The mean gap of sorted dates is (newest - oldest) / (n - 1), so no ordering of a feed is needed.
    """
    per_guid = entries.groupBy(feed, guid).agg(
        F.count("*").alias("n"), F.count(ts).alias("n_dated"), F.min(ts).alias("oldest"), F.max(ts).alias("newest"),
        F.count_if("canonical").alias("n_canonical"), F.count_if("relay").alias("n_relay"),
    )
    out = per_guid.groupBy(feed).agg(
        F.sum("n").alias("items"), F.sum("n_dated").alias("n_dated"), F.min("oldest").alias("oldest"), F.max("newest").alias("newest"),
        F.sum("n_canonical").alias("n_canonical"), F.sum("n_relay").alias("n_relay"),
        F.sum(F.when(F.col(guid).isNotNull(), F.col("n") - 1).otherwise(0)).alias("duplicate_guids"),
    )
    day = F.lit(86400000000.0)
    span = (F.unix_micros("newest") - F.unix_micros("oldest")) / day
    return out.select(
        feed, "items", "newest",
        F.round((F.unix_micros(now) - F.unix_micros("newest")) / day, 2).alias("age_days"),
        F.when(F.col("n_dated") >= 2, F.round(span / (F.col("n_dated") - 1), 2)).alias("average_gap_days"),
        F.round(F.col("n_canonical") / F.col("items"), 3).alias("canonical_coverage"),
        F.round(F.col("n_relay") / F.col("items"), 3).alias("relay_ratio"),
        "duplicate_guids",
    )


SEVERITY = ("failing", "degraded", "stale", "quiet", "healthy")


def worst_status(feeds: DataFrame, sources: DataFrame, source: str, status: str) -> DataFrame:
    """AG12. The worst feed status per source; a source without a checked feed is degraded."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITY]), F.col(status))
    worst = feeds.groupBy(source).agg(F.min(rank).cast("int").alias("_worst"))
    named = F.when(F.col("_worst") > 0, F.get(F.array(*[F.lit(s) for s in SEVERITY]), F.col("_worst") - 1))
    return sources.join(worst, source, "left").withColumn("source_status", F.coalesce(named, F.lit("degraded"))).drop("_worst")


def review_batches(rows: DataFrame, source: str) -> DataFrame:
    """AG15. Numbered batches, one per source, most frequent first. One row per source is ranked, and in segments of equal counts."""
    counts = rows.groupBy(F.coalesce(F.nullif(F.col(source), F.lit("")), F.lit("unclassified")).alias("source")).agg(F.count("*").alias("n_rows"))
    return segments.row_number(counts, [], -F.col("n_rows"), [F.col("source")], "batch")


def last_runs_trend(history: DataFrame, run: str, value: str, runs: int = 7, minimum: int = 2) -> DataFrame:
    """AG17. Mean over the last runs, given at least two of them."""
    per_run = history.groupBy(run).agg(F.sum(value).alias("_v"))
    recent = per_run.orderBy(F.col(run).desc()).limit(runs)
    return recent.agg(F.count("*").alias("runs"), F.avg("_v").alias("mean"), F.min("_v").alias("low"), F.max("_v").alias("high")).where(
        F.col("runs") >= minimum
    )


def distinct_counts(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """AG18. Exact counts group per column first; the approximate ones use a sketch and no shuffle of values."""
    if not exact:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    return df.agg(*[F.countDistinct(c).alias(c) for c in columns])


def period_sketches(df: DataFrame, period: Column, keys: list[str], columns: list[str], bits: int = 12) -> DataFrame:
    """AG18. One row per period and keys with a mergeable sketch of the distinct values of each column, to be stored: counts of
    any span of periods come from these rows, without the values. The standard error is 1.04 / sqrt(2 ** bits)."""
    return df.groupBy(period.alias("period"), *keys).agg(*[F.hll_sketch_agg(F.col(c), F.lit(bits)).alias(c) for c in columns])


def united_counts(sketches: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """AG18. Approximate distinct counts over all periods of stored sketches, per keys."""
    return sketches.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])


def newest_runs_median(df: DataFrame, key: str, order: list[Column], values: list[str], runs: int = 3) -> DataFrame:
    """AG19. Median by position of the newest runs of each key."""
    recent = df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_rn") <= runs)
    out = recent.groupBy(key).agg(F.count("*").alias("runs"), *[F.sort_array(F.collect_list(v)).alias(v) for v in values])
    return out.select(key, "runs", *[F.get(F.col(v), F.floor(F.size(v) / 2).cast("int")).alias(v) for v in values])


def month_index(editions: DataFrame, day: str, count: str, lead: str) -> DataFrame:
    """AG20. Editions and items per month with the lead title of the newest edition."""
    return editions.where(F.col(count) > 0).groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(
        F.count("*").alias("editions"), F.sum(count).alias("items"), F.max_by(lead, day).alias("lead_title")
    )
