from pyspark.sql import functions as F

from broadsheet.operators import windows
from broadsheet.streaming import streams as S


def feed_in(spark, path, batches, schema):
    """A file stream that reads one small file per micro-batch, in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/in/part={i}")
    return spark.readStream.schema(spark.read.parquet(f"{path}/in/part=0").schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{path}/in")


def test_streaks_equal_batch_whatever_the_order(spark, tmp_path):
    schema = "feed string, o long, ok boolean"
    batches = [[("a", 5, True), ("a", 1, True), ("b", 1, False)], [("a", 2, False), ("a", 4, True), ("b", 2, True)], [("a", 3, True)] + [("c", i, True) for i in range(25)]]
    stream = feed_in(spark, str(tmp_path), batches, schema)
    out = f"{tmp_path}/out"
    S.run_available(S.success_streaks(stream, "feed", "o", "ok"), S.edition_sink(out), f"{tmp_path}/cp", "update")
    got = {r.feed: r.consecutive_successes for r in S.read_edition(spark, out, ["feed"]).collect()}
    whole = spark.createDataFrame([r for b in batches for r in b], schema)
    want = {r.feed: r.consecutive_successes for r in windows.success_streak(whole, "feed", "o", "ok").collect()}
    assert got == want == {"a": 3, "b": 1, "c": 20}


def test_retry_sink_keeps_failures_available_and_replays(spark, tmp_path):
    schema = "k string, ok boolean, o long"
    batches = [[("a", True, 1), ("b", False, 2)], [("a", True, 3), ("b", True, 4)], [("b", True, 5)]]
    sink = S.retry_sink(f"{tmp_path}/out", f"{tmp_path}/seen", "k", "ok", [F.col("o")])
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema)
        sink(df, i)
        sink(df, i)  # the same batch delivered again
    assert sorted((r.k, r.o) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [("a", 1), ("b", 4)]


def test_seen_list_is_bounded(spark, tmp_path):
    sink = S.retry_sink(f"{tmp_path}/out", f"{tmp_path}/seen", "k", "ok", [F.col("o")], keep_batches=2)
    for i in range(3):
        sink(spark.createDataFrame([(f"k{i}", True, i)], "k string, ok boolean, o long"), i)
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/seen/after=2").collect()) == ["k1", "k2"]


def test_dedup_over_batches_and_edition_replay(spark, tmp_path):
    schema = "k string, t string"
    stream = feed_in(spark, str(tmp_path), [[("a", "2024-01-01"), ("b", "2024-01-01")], [("a", "2024-01-02"), ("c", "2024-01-02")]], schema).withColumn("ts", F.col("t").cast("timestamp"))
    query = S.run_available(S.dedup_within(stream, "k", "ts"), S.edition_sink(f"{tmp_path}/out"), f"{tmp_path}/cp")
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b", "c"]
    assert S.progress_rows(spark, query).agg(F.sum("input_rows")).first()[0] == 4
    write = S.edition_sink(f"{tmp_path}/edition")
    for _ in range(2):
        write(spark.createDataFrame([("a", 1)], "k string, v long"), 0)
    write(spark.createDataFrame([("a", 2)], "k string, v long"), 1)
    assert spark.read.parquet(f"{tmp_path}/edition").count() == 2
    assert S.read_edition(spark, f"{tmp_path}/edition", ["k"]).first().v == 2


def test_windows_start_where_they_should(spark):
    df = spark.createDataFrame([("2024-01-01 14:59:59",), ("2024-01-01 15:00:00",)], "t string").withColumn("ts", F.col("t").cast("timestamp"))
    days = sorted(str(r.window_start) for r in S.daily(df, "ts", []).collect())
    assert days == ["2023-12-31 15:00:00", "2024-01-01 15:00:00"]
    assert [r.window_start.weekday() for r in S.weekly(df, "ts", []).collect()] == [0]


def test_progress_counters_are_clamped(spark):
    c = S.progress_counters(F.lit(10), F.lit(8), F.lit(-1))
    d = S.progress_counters(F.lit(3), F.lit(9), F.lit(9))
    a, b = spark.range(1).select(c.alias("a"), d.alias("b")).first()
    assert (a.completed, a.remaining, a.failed) == (8, 2, 0) and (b.completed, b.remaining, b.share) == (3, 0, 1.0)


def test_last_sessions_close_over_several_batches(spark, tmp_path):
    """A session that spans files stays open until a heartbeat has moved the watermark past its end."""
    schema = "feed string, t string"
    hours = lambda f, *hs: [(f, f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00") for h in hs]
    batches = [hours("a", 0, 5), hours("a", 10) + hours("b", 12), hours("a", 40, 45)]
    stream = lambda: feed
    feed = feed_in(spark, str(tmp_path), batches, schema).withColumn("ts", F.col("t").cast("timestamp"))
    out = f"{tmp_path}/out"

    def run():
        S.run_available(S.poll_sessions(stream(), "ts", "feed", "12 hours", "1 hour"), S.edition_sink(out), f"{tmp_path}/cp")
        return sorted((r.feed, str(r.session_start), r.n) for r in S.read_edition(spark, out, ["feed", "session_start"]).collect())

    first = run()
    assert ("a", "2024-01-02 16:00:00", 2) not in first
    for k in (3, 4):
        spark.createDataFrame([(None, f"2024-02-0{k} 00:00:00")], schema).coalesce(1).write.parquet(f"{tmp_path}/in/part={k}")
        last = run()
    assert last == [("a", "2024-01-01 00:00:00", 3), ("a", "2024-01-02 16:00:00", 2), ("b", "2024-01-01 12:00:00", 1)]


def test_progress_log_has_a_row_per_batch(spark, tmp_path):
    stream = feed_in(spark, str(tmp_path), [[("a",)], [("b",), ("c",)], [("d",)] * 3], "k string")
    log = S.run_logged(stream, S.edition_sink(f"{tmp_path}/out"), f"{tmp_path}/cp", "logged", f"{tmp_path}/log")
    assert sorted((r.batch_id, r.input_rows) for r in log.collect()) == [(0, 1), (1, 2), (2, 3)]
    assert all(r.started for r in log.collect()) and spark.streams.active == []
