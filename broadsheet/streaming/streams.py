"""ST1-ST12: Structured Streaming operators.

All functions take and return streaming DataFrames, except the sinks, which are ``foreachBatch`` functions. State is
bounded by the watermark; where the bound is a count (the seen list), the state is a table.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..constants import FEED_MAX_AGE_DAYS
from ..operators.dedup import first_per_key
from ..operators.monitor import freshness

Batch = Callable[[DataFrame, int], None]


def dedup_within(stream: DataFrame, key: str, ts: str, horizon: str = "10 days") -> DataFrame:
    """ST1. First row per key; a key is forgotten once the watermark has passed it by the horizon."""
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


def drop_late(stream: DataFrame, ts: str, now: Column, days: int = FEED_MAX_AGE_DAYS) -> DataFrame:
    """ST2. Rows older than the limit go before they reach any state."""
    return stream.withWatermark(ts, f"{days} days").where(F.col(ts) >= now - F.make_interval(days=F.lit(days)))


def _windowed(stream: DataFrame, ts: str, window: Column, keys: list[str], delay: str, value: str | None) -> DataFrame:
    measures = [F.count("*").alias("n")] + ([F.sum(value).alias("total")] if value else [])
    out = stream.withWatermark(ts, delay).groupBy(window, *keys).agg(*measures)
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *out.columns[1 + len(keys):])


def daily(stream: DataFrame, ts: str, keys: list[str], delay: str = "10 days", value: str | None = None) -> DataFrame:
    """ST3. Days in KST: midnight there is 15:00 UTC."""
    return _windowed(stream, ts, F.window(ts, "1 day", "1 day", "15 hours"), keys, delay, value)


def weekly(stream: DataFrame, ts: str, keys: list[str], delay: str = "10 days", value: str | None = None) -> DataFrame:
    """ST4. Weeks from Monday; the epoch was a Thursday."""
    return _windowed(stream, ts, F.window(ts, "7 days", "7 days", "4 days"), keys, delay, value)


def recent_news(stream: DataFrame, ts: str, keys: list[str], delay: str = "10 days", value: str | None = None) -> DataFrame:
    """ST5. Two-day windows that start every day."""
    return _windowed(stream, ts, F.window(ts, "2 days", "1 day"), keys, delay, value)


def poll_sessions(stream: DataFrame, ts: str, feed: str, gap: str = "3 days", delay: str = "10 days") -> DataFrame:
    """ST6. Runs of publications of a feed without a longer pause.

    A session is emitted once the watermark has passed its end. When the feeds fall silent, a heartbeat (a row without a feed and
    with a later time) moves the watermark on, so the last sessions close as well; rows without a feed make no session.
    """
    stream = stream.withWatermark(ts, delay)
    out = stream.groupBy(F.session_window(ts, gap), feed).agg(F.count("*").alias("n"))
    # Asked of the count, so that the filter stays above the watermark and heartbeats are seen there.
    out = out.where(F.when(F.col(feed).isNotNull(), F.col("n")) > 0)
    return out.select(feed, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


def success_streaks(stream: DataFrame, feed: str, order: str, success: str, cap: int = 20) -> DataFrame:
    """ST7. Successes in a row per feed, at most ``cap``.

    The state is the last failure and the ``cap`` latest successes after it. That is all the capped count needs, rows may
    arrive in any order, and the rows of a feed are read in chunks.
    """

    def update(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        failed, latest = state.get if state.exists else (None, [])
        latest = list(latest)
        for chunk in chunks:
            good = chunk[success].astype(bool)
            bad = chunk.loc[~good, order]
            if len(bad):
                failed = int(bad.max()) if failed is None else max(failed, int(bad.max()))
            latest = sorted(set(latest) | set(chunk.loc[good, order].nlargest(cap).astype(int)), reverse=True)[:cap]
        latest = [o for o in latest if failed is None or o > failed]
        state.update((failed, latest))
        yield pd.DataFrame({feed: [key[0]], "consecutive_successes": [len(latest)]})

    key_type = stream.schema[feed].dataType.simpleString()
    return stream.select(feed, order, success).groupBy(feed).applyInPandasWithState(
        update, f"{feed} {key_type}, consecutive_successes long", "failed long, latest array<long>", "update", GroupStateTimeout.NoTimeout
    )


def enrich(stream: DataFrame, dimension: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """ST12. Registry attributes onto the stream; the static side is read again for each batch."""
    return stream.join(dimension, stream[left_key] == dimension[right_key], "left")


# --- Sinks ---------------------------------------------------------------------------------------------


def edition_sink(path: str) -> Batch:
    """ST8. Each batch goes to its own folder, named by the batch id, so a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_edition(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """ST8. Merged edition: the latest batch wins per key."""
    return first_per_key(spark.read.parquet(path), keys, [F.col("batch_id").desc()])


def retry_sink(out_path: str, seen_path: str, key: str, ok: str, order: list[Column], keep_batches: int | None = None) -> Batch:
    """ST1, ST9. New rows only; successes are written and recorded as seen, failures stay available for the next poll.

    Seen keys are kept, or those of the last ``keep_batches`` batches where it is given. The list is stored per batch, and batch n reads what batch n - 1 left, so a replay of a
    batch sees the same list and writes the same rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = first_per_key(batch.where(ok), [key], order)
        slim = fresh.select(key, F.lit(batch_id).alias("seen_batch"))
        if batch_id > 0:
            seen = spark.read.parquet(f"{seen_path}/after={batch_id - 1}").select(key, "seen_batch")
            fresh = fresh.join(seen, key, "left_anti")
            slim = fresh.select(key, F.lit(batch_id).alias("seen_batch")).unionByName(seen)
        fresh.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        recent = slim if keep_batches is None else slim.where(F.col("seen_batch") > batch_id - keep_batches)
        recent.write.mode("overwrite").parquet(f"{seen_path}/after={batch_id}")

    return write


def run_available(stream: DataFrame, sink: Batch, checkpoint: str, mode: str = "append", name: str | None = None):
    """Process everything there is, then stop; the checkpoint folder must be shared by all executors."""
    writer = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = (writer.queryName(name) if name else writer).start()
    query.awaitTermination()
    return query


class ProgressLog(StreamingQueryListener):
    """ST10. Writes a row per micro-batch of one named query to a shared table, as the batches end.

    A batch has a folder of its own, so a batch that runs again after a restart replaces its row. Between start and termination
    the table can be read at any time; ``finished`` waits until the last row is written.
    """

    def __init__(self, spark: SparkSession, name: str, path: str):
        self._spark, self._name, self._path, self._run, self._done = spark, name, path, None, threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self._name:
            self._run = str(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name == self._name and p.numInputRows:  # a batch without rows only closes windows
            row = [(p.numInputRows, float(p.processedRowsPerSecond), p.timestamp)]
            self._spark.createDataFrame(row, "input_rows long, rows_per_second double, started string").write.mode("overwrite").parquet(f"{self._path}/batch_id={p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self._run:
            self._done.set()

    def finished(self, seconds: float = 60) -> DataFrame:
        """The table, once the query has ended."""
        if not self._done.wait(seconds):
            raise TimeoutError(f"no end of query {self._name} within {seconds} s")
        return self._spark.read.parquet(self._path)


def run_logged(stream: DataFrame, sink: Batch, checkpoint: str, name: str, log_path: str, mode: str = "append") -> DataFrame:
    """ST10. Run a stream to its end and return its progress table (batch_id, input_rows, rows_per_second, started)."""
    spark = stream.sparkSession
    log = ProgressLog(spark, name, log_path)
    spark.streams.addListener(log)
    try:
        run_available(stream, sink, checkpoint, mode, name)
        return log.finished()
    finally:
        spark.streams.removeListener(log)


def progress_rows(spark: SparkSession, query) -> DataFrame:
    """ST10. One row per micro-batch from Spark's own progress: selected, and per second; these are a few numbers each."""
    rows = [(p.batchId, p.numInputRows, float(p.processedRowsPerSecond)) for p in query.recentProgress]
    return spark.createDataFrame(rows, "batch_id long, input_rows long, rows_per_second double")


def progress_counters(selected: Column, generated: Column, failed: Column) -> Column:
    """ST10. Counters clamped to what is possible: completed within selected, generated and failed within completed."""
    whole = lambda c: F.greatest(F.lit(0), F.floor(F.coalesce(c, F.lit(0))))
    total = whole(selected)
    done = F.least(total, whole(generated) + whole(failed))
    return F.struct(
        total.alias("selected"), done.alias("completed"), F.least(done, whole(generated)).alias("generated"), F.least(done, whole(failed)).alias("failed"),
        (total - done).alias("remaining"), F.when(total > 0, F.round(done / total, 4)).otherwise(F.lit(0.0)).alias("share"),
    )


def stale_alert(sink_table: DataFrame, ts: str, today: Column, max_age: int = 3) -> DataFrame:
    """ST11. Freshness codes of what the sink holds."""
    newest = sink_table.agg(F.date_format(F.max(ts), "yyyy-MM-dd").alias("latest"), F.count("*").alias("n"))
    return newest.select("latest", "n", freshness(F.col("latest"), today, F.col("n"), F.lit(None), max_age).alias("codes"))
