"""Queries for streaming operators (ST*). Each one reads the events table as a stream and runs until all is processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedup import first_per_key
from ..session import shared_folder
from ..streaming import streams as S
from . import query
from .tables import NOW, now, table


SLICES = 4


def slice_of():
    """The quarter of the whole time that an event falls into."""
    us = F.unix_micros("ts")
    return F.expr(f"(unix_micros(ts) - lo) * {SLICES} div (hi - lo + 1)"), F.min(us).alias("lo"), F.max(us).alias("hi")


SQL_SLICES = f"sl AS (SELECT e.*, (epoch_us(ts) - lo) * {SLICES} // (hi - lo + 1) AS slice FROM events e CROSS JOIN (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events))"


def event_files(spark, sf):
    """A folder with events as files in the order of time: each of the ``SLICES`` has the same number of files."""
    events = table(spark, sf, "events")
    number, lo, hi = slice_of()
    ends = events.agg(lo, hi).first()
    files = max(1, events.rdd.getNumPartitions())
    folder = shared_folder(spark, "events")
    sliced = events.withColumns({"lo": F.lit(ends["lo"]), "hi": F.lit(ends["hi"])}).withColumn("slice", number).drop("lo", "hi")
    for k in range(SLICES):
        sliced.where(F.col("slice") == k).drop("slice").repartition(files).write.mode("append").parquet(folder)
    return folder, files


def read_files(spark, sf, folder, files):
    return spark.readStream.schema(table(spark, sf, "events").schema).option("maxFilesPerTrigger", files).parquet(folder)


def event_stream(spark, sf):
    """events as a stream of ``SLICES`` micro-batches in the order of time."""
    return read_files(spark, sf, *event_files(spark, sf))


def heartbeat(spark, sf, folder, days):
    """A row without a user, so many days after the last event."""
    events = table(spark, sf, "events")
    last = F.timestamp_micros(F.lit(events.agg(F.max(F.unix_micros("ts"))).first()[0])) + F.make_dt_interval(F.lit(days))
    events.limit(1).select(*[(last if c == "ts" else F.lit(None).cast(t)).alias(c) for c, t in events.dtypes]).write.mode("append").parquet(folder)


def settled(spark, stream, keys, mode="update"):
    """Run the stream to its end and read the latest state per key."""
    folder = shared_folder(spark, "stream")
    S.run_available(stream, S.edition_sink(f"{folder}/out"), f"{folder}/checkpoint", mode)
    return S.read_edition(spark, f"{folder}/out", keys)


@query("st1_dedup_within", "SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, props FROM events) GROUP BY user_id")
def _(spark, sf):
    e = event_stream(spark, sf).withColumn("key", F.concat_ws("|", "user_id", "props"))
    kept = settled(spark, S.dedup_within(e, "key", "ts", "40 days"), ["key"], "append")
    return kept.groupBy("user_id").agg(F.count("*").alias("n"))


@query("st2_drop_late", f"SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 10 DAY GROUP BY 1")
def _(spark, sf):
    kept = settled(spark, S.drop_late(event_stream(spark, sf), "ts", now()), ["event_id"], "append")
    return kept.groupBy("event_type").agg(F.count("*").alias("n"))


@query("st3_daily", "SELECT strftime(date_trunc('day', ts + INTERVAL 9 HOUR), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, sf):
    d = settled(spark, S.daily(event_stream(spark, sf), "ts", ["event_type"]), ["window_start", "event_type"])
    return d.select(F.date_format(F.col("window_start") + F.expr("INTERVAL 9 HOURS"), "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("st4_weekly", "SELECT strftime(ts, '%G-W%V') AS week, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _(spark, sf):
    from ..functions.dates import iso_week

    w = settled(spark, S.weekly(event_stream(spark, sf), "ts", [], value="value"), ["window_start"])
    return w.select(iso_week(F.col("window_start")).alias("week"), "n", F.round("total", 2).alias("total"))


@query("st5_recent_news", """
    SELECT strftime(d, '%Y-%m-%d') AS start, count(*) AS n FROM (SELECT unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS d FROM events) GROUP BY 1""")
def _(spark, sf):
    w = settled(spark, S.recent_news(event_stream(spark, sf), "ts", []), ["window_start"])
    return w.select(F.date_format("window_start", "yyyy-MM-dd").alias("start"), "n")


@query("st6_poll_sessions", """
    WITH g AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) < 12 * 3600000000 THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, sid""")
def _(spark, sf):
    """Sessions that the stream has closed. Two heartbeats after the last event close the last ones: the first moves the
    watermark past their ends, the next one lets the stream act on it."""
    folder, files = event_files(spark, sf)
    out = shared_folder(spark, "sessions")
    for days in (30, 31):
        heartbeat(spark, sf, folder, days)
        sessions = S.poll_sessions(read_files(spark, sf, folder, files), "ts", "user_id", "12 hours", "2 days")
        S.run_available(sessions, S.edition_sink(f"{out}/out"), f"{out}/checkpoint", "append")
    w = S.read_edition(spark, f"{out}/out", ["user_id", "session_start"])
    return w.select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("st7_success_streaks", """
    WITH f AS (SELECT user_id, max(event_id) AS failed FROM events WHERE event_type = 'error' GROUP BY 1)
    SELECT e.user_id AS feed, least(20, count(*) FILTER (event_type <> 'error' AND (failed IS NULL OR event_id > failed))) AS consecutive_successes FROM events e LEFT JOIN f ON f.user_id = e.user_id GROUP BY 1""")
def _(spark, sf):
    runs = event_stream(spark, sf).select(F.col("user_id").alias("feed"), "event_id", (F.col("event_type") != "error").alias("ok"))
    return settled(spark, S.success_streaks(runs, "feed", "event_id", "ok"), ["feed"]).select("feed", "consecutive_successes")


@query("st8_edition_merge", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id")
def _(spark, sf):
    folder = shared_folder(spark, "edition")
    S.run_available(event_stream(spark, sf), S.edition_sink(f"{folder}/out"), f"{folder}/checkpoint")
    return first_per_key(spark.read.parquet(f"{folder}/out"), ["user_id"], [F.col("batch_id").desc(), F.col("event_id").desc()]).select("user_id", "event_id")


@query("st9_retry", "SELECT user_id, min(event_id) AS event_id FROM events WHERE event_type <> 'error' GROUP BY user_id")
def _(spark, sf):
    folder = shared_folder(spark, "retry")
    sink = S.retry_sink(f"{folder}/out", f"{folder}/seen", "user_id", "event_type <> 'error'", [F.col("event_id")])
    S.run_available(event_stream(spark, sf), sink, f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").select("user_id", "event_id")


@query("st10_progress", "SELECT user_id, count(*) AS selected, count(*) FILTER (event_type <> 'signup') AS completed, count(*) FILTER (event_type = 'signup') AS remaining FROM events GROUP BY 1")
def _(spark, sf):
    counts = event_stream(spark, sf).groupBy("user_id").agg(
        F.count("*").alias("s"), F.count_if(F.col("event_type").isin("view", "click", "purchase")).alias("g"), F.count_if(F.col("event_type") == "error").alias("f")
    )
    e = settled(spark, counts, ["user_id"])
    return e.withColumn("p", S.progress_counters(F.col("s"), F.col("g"), F.col("f"))).select("user_id", "p.selected", "p.completed", "p.remaining")


@query("st10_progress_table", f"WITH {SQL_SLICES} SELECT CAST(slice AS INTEGER) AS batch_id, count(*) AS input_rows FROM sl GROUP BY 1")
def _(spark, sf):
    """What a listener wrote about each micro-batch while the stream ran."""
    folder = shared_folder(spark, "logged")
    log = S.run_logged(event_stream(spark, sf), S.edition_sink(f"{folder}/out"), f"{folder}/checkpoint", "st10_progress_table", f"{folder}/progress")
    return log.select("batch_id", "input_rows")


@query("st11_stale_alert", "SELECT strftime(max(ts), '%Y-%m-%d') AS latest, count(*) AS n, CASE WHEN DATE '2024-02-05' - CAST(max(ts) AS DATE) > 3 THEN 'latest-stale' ELSE '' END AS codes FROM events")
def _(spark, sf):
    """The alert reads the table that a stream has written."""
    folder = shared_folder(spark, "sink")
    S.run_available(event_stream(spark, sf), S.edition_sink(f"{folder}/out"), f"{folder}/checkpoint")
    a = S.stale_alert(spark.read.parquet(f"{folder}/out"), "ts", F.lit("2024-02-05"))
    return a.select("latest", "n", F.array_join("codes", ",").alias("codes"))


@query("st12_enrich", "SELECT event_id, c_mktsegment FROM events LEFT JOIN customer ON c_custkey = user_id")
def _(spark, sf):
    e = S.enrich(event_stream(spark, sf), table(spark, sf, "customer"), "user_id", "c_custkey")
    return settled(spark, e, ["event_id"], "append").select("event_id", "c_mktsegment")
