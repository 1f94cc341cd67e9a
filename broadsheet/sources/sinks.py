"""SK1-SK10: what is written, and the writers.

The DataFrame functions say what the new state is; the ``write_*`` functions only store it.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import once, settle
from ..operators.dedup import first_per_key


def merge_edition(existing: DataFrame, new: DataFrame, day: str, row: str, keys: str) -> DataFrame:
    """SK1. Existing items stay; a new item is added unless one of its keys is in the same edition already."""
    known = existing.select(day, F.explode(keys).alias("_key"))
    claims = new.select(row, day, F.explode(keys).alias("_key"))
    taken = claims.join(known, [day, "_key"], "left_semi").select(row).distinct()
    return existing.unionByName(new.join(taken, row, "left_anti"))


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """SK2, SK7. Incoming rows replace existing ones; within the incoming rows the last write wins."""
    latest = first_per_key(incoming, keys, order)
    return existing.join(latest.select(*keys), keys, "left_anti").unionByName(latest, allowMissingColumns=True)


def search_manifest(entries: DataFrame, month: str, payload: list[str]) -> DataFrame:
    """SK3. Entries and bytes per monthly chunk."""
    size = F.octet_length(F.to_json(F.struct(*payload)))
    return entries.groupBy(month).agg(F.count("*").alias("n_entries"), F.sum(size.cast("long")).alias("n_bytes"))


def write_search_chunks(entries: DataFrame, month: str, path: str) -> None:
    """SK3. One folder per month; a hot month is written by several tasks, since rows are not gathered by month."""
    entries.write.mode("overwrite").partitionBy(month).option("maxRecordsPerFile", 500_000).json(path)


def append_events(events: DataFrame, path: str) -> None:
    """SK4."""
    events.write.mode("append").json(path)


def bounded_history(history: DataFrame, run: DataFrame, run_ts: str, keep: int | None = None) -> DataFrame:
    """SK5. History with the new run; the last ``keep`` runs only if it is given."""
    rows = history.unionByName(run, allowMissingColumns=True)
    if keep is None:
        return rows
    last = rows.select(run_ts).distinct().orderBy(F.col(run_ts).desc()).limit(keep)
    return rows.join(last, run_ts, "left_semi")


def bounded_seen(seen: DataFrame, bucket: Column, order: list[Column], keep: int) -> DataFrame:
    """SK6. The newest ``keep`` keys. ``bucket`` is a coarse time, such as the day, that the order starts with: counts per bucket
    tell which ones can hold the newest keys, so that not every task sends ``keep`` rows to the last one."""
    counts = seen.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"))
    newer = Window.partitionBy(F.lit(0)).orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("_newer", F.coalesce(F.sum("_n").over(newer), F.lit(0))).where(F.col("_newer") < keep)
    oldest = needed.agg(F.min("_bucket")).scalar()
    return seen.where(bucket >= oldest).orderBy(*order).limit(keep)


def write_by_day(rows: DataFrame, day: str, path: str) -> None:
    """SK1, SK2, SK10. Replace only the days that occur in the rows."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def latest_edition(items: DataFrame, day: str, renderable: Column) -> DataFrame:
    """SK8. Items of the newest edition that can be shown; the newest day is a scalar subquery."""
    today = items.where(F.col(day) == items.agg(F.max(day)).scalar())
    return settle(today, _shown=renderable).where("_shown").drop("_shown")


def publish_blockers(items: DataFrame, contract: Column, publish: Column, now: Column) -> DataFrame:
    """SK9. Reasons per item that keep an edition from being published."""
    contract_left = F.filter(contract, lambda i: ~i.isin("workflow-status-missing", "published-at-missing"))
    state = F.coalesce("workflow_status", F.lit("missing"))
    reasons = F.array_compact(
        F.array(
            F.when(state != "approved", F.concat(F.lit("workflow-status:"), state)),
            once(contract_left, lambda found: F.when(F.size(found) > 0, F.concat(F.lit("contract:"), F.array_join(found, ",")))),
            once(publish, lambda found: F.when(F.size(found) > 0, F.concat(F.lit("quality:"), F.array_join(found, ",")))),
            F.when(F.col("scheduled_at") > now, F.lit("scheduled-later")),
        )
    )
    return settle(items, reasons=reasons)


def stamp_published(items: DataFrame, now: Column) -> DataFrame:
    """SK9. Publication dates and state of a released edition."""
    return items.withColumns(
        {"published_at": F.coalesce("published_at", now), "first_published_at": F.coalesce("first_published_at", "published_at", now), "workflow_status": F.lit("published")}
    )


def publish_edition(items: DataFrame, contract: Column, publish: Column, now: Column, day: str, path: str) -> bool:
    """SK9. Write the edition if no item is blocked; returns whether it was written."""
    blocked = publish_blockers(items, contract, publish, now).where(F.size("reasons") > 0)
    if not blocked.isEmpty():
        return False
    write_by_day(stamp_published(items, now), day, path)
    return True


def bucket_by_day(new: DataFrame, existing: DataFrame, ts: str, row: str, keys: str, day: str = "day") -> DataFrame:
    """SK10. New items under the KST day of their publication, without those the day holds already."""
    from ..functions.dates import kst_date

    dated = new.withColumn(day, kst_date(F.col(ts)))
    known = existing.select(day, F.explode(keys).alias("_key"))
    taken = dated.select(row, day, F.explode(keys).alias("_key")).join(known, [day, "_key"], "left_semi").select(row).distinct()
    return dated.join(taken, row, "left_anti")


