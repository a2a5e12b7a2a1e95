"""Streams over several files give the rows of their batch twins; restarts lose and repeat nothing."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggs, alerts
from millrace.operators.ordered import row_numbers
from millrace.session import scratch_path
from millrace.sources import envelope, files
from millrace.sources.tables import ntz_to_timestamp
from millrace.streaming import keyed_state as state
from millrace.streaming import sinks
from millrace.streaming.run import batch_folders, drain_until, each_batch, read_batches

ORDER = ["ts", "event_id"]
PIECES = 4


@pytest.fixture(scope="module")
def events(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet")
    return ntz_to_timestamp(df).drop("props").cache()


@pytest.fixture(scope="module")
def in_order(spark, events):
    """The events as files that arrive one after the other."""
    path = scratch_path(spark, "in-order")
    edges = [i * 1000 // PIECES for i in range(PIECES + 1)]
    for lo, hi in zip(edges, edges[1:]):
        piece = events.where((F.col("event_id") >= lo) & (F.col("event_id") < hi))
        piece.coalesce(1).write.mode("append").parquet(path)
    return path


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def readings(spark, path, schema):
    df = stream_of(spark, path, schema)
    return df.select("user_id", F.col("event_id").alias("seq"), "ts", "value", "event_type")


def processed(rows, processor, until, delay="0 seconds"):
    """Everything the processor emits until the end of its stream, late rows included."""
    return drain_until(rows, "ts", delay, until, lambda r: state.apply_state(r, "user_id", processor), "t-state")


@pytest.fixture(scope="module")
def end(events):
    return F.lit(events.agg(F.max("ts")).first()[0])


@pytest.fixture(scope="module")
def in_any_order(spark, events):
    """The events dealt over files that each span the whole time."""
    path = scratch_path(spark, "any-order")
    for i in range(PIECES):
        events.where(F.col("event_id") % PIECES == (i * 3) % PIECES).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(params=["in order", "in any order"])
def run(request, spark, events, in_order, in_any_order, end):
    path, delay = (in_order, "0 seconds") if request.param == "in order" else (in_any_order, "40 days")
    past_end = end + F.expr("interval 2 milliseconds")

    def go(processor, change=lambda rows: rows, until=past_end):
        emitted = processed(change(readings(spark, path, events.schema)), processor, until, delay)
        assert state.late(emitted, "user_id").isEmpty()
        return state.on_time(emitted)

    return go


def test_running_count_over_batches(events, run, rows_of):
    out = run(state.RunningCount())
    batch = row_numbers(events, ["user_id"], ORDER, "running")
    assert rows_of(out.select("user_id", "seq", "running")) == rows_of(batch.select("user_id", "event_id", "running"))


def test_alerts_over_batches(events, run, end, rows_of):
    jumps = run(state.JumpAlert(20.0))
    twin = alerts.jump(events, ["user_id"], ORDER, "value", 20.0)
    assert rows_of(jumps) == rows_of(twin.select("user_id", "event_id", "previous", "value"))

    rises = run(state.SustainedRise(4 * 3600))
    twin = alerts.sustained_rise(events, "user_id", ORDER, "value", 4 * 3600, until=end)
    assert rows_of(rises) == rows_of(twin)

    silent = run(state.Inactivity(24 * 3600))
    twin = alerts.inactivity(events, ["user_id"], ORDER, "24 hours", until=end)
    assert rows_of(silent) == rows_of(twin)


def test_blacklist_and_count_windows_over_batches(events, run, rows_of):
    hits = run(state.RateBlacklist(3, 8))
    twin = alerts.rate_blacklist(events, "user_id", ORDER, 3)
    assert rows_of(hits.select("user_id", "seq", "n")) == rows_of(twin.select("user_id", "event_id", "n"))

    averages = run(state.CountWindowAvg(2), lambda rows: rows.withColumn("value", F.floor("value").cast("double")))
    floored = events.withColumn("v", F.floor("value").cast("long"))
    twin = aggs.count_window_avg(floored, ["user_id"], ORDER, "v", 2)
    assert rows_of(averages) == rows_of(twin.select("user_id", "window_no", "avg_value"))


def test_last_n_over_batches(events, run, rows_of):
    last = run(state.LastN(3)).groupBy("user_id").agg(F.max_by("last_values", F.struct("ts", "seq")))
    assert rows_of(last) == rows_of(aggs.last_n_values(events, ["user_id"], ORDER, "value", 3))


def test_asof_join_over_batches(events, run, end, rows_of):
    from millrace.operators import joins

    def sided(rows):
        rows = rows.where("event_type in ('purchase', 'signup')")
        return rows.withColumn("side", F.when(F.col("event_type") == "purchase", 1).otherwise(0)).drop("event_type")

    out = run(state.AsOfJoin(), sided, end)
    # the last row of all waits for a later watermark
    passed = events.where(F.col("ts") < events.agg(F.max("ts")).first()[0])
    left, right = passed.where("event_type = 'purchase'"), events.where("event_type = 'signup'")
    twin = joins.asof_join(left, right, ["user_id"], "ts", "ts", {"v": "value"}, ["event_id"])
    assert rows_of(out.select("user_id", "seq", "version_value")) == rows_of(twin.select("user_id", "event_id", "v"))


def test_sessions_in_any_order(spark, events, in_any_order, end, rows_of):
    def grouped(rows):
        out = rows.groupBy(F.session_window("ts", "2 hours").alias("w"), "user_id").agg(F.count("*").alias("n"))
        return out.select("user_id", "w.start", "w.end", "n")

    out = drain_until(stream_of(spark, in_any_order, events.schema), "ts", "40 days", end, grouped, "t-sessions")
    twin = aggs.sessions(events, ["user_id"], ORDER, "2 hours", [F.count("*").alias("n")]).where(F.col("session_end") <= end)
    assert out.count() > 0 and rows_of(out) == rows_of(twin.select("user_id", "session_start", "session_end", "n"))


def test_late_rows_come_out_as_such(spark, events, in_any_order, end, rows_of):
    emitted = processed(readings(spark, in_any_order, events.schema), state.RunningCount(), end + F.expr("interval 2 milliseconds")).cache()
    late, counted = state.late(emitted, "user_id"), state.on_time(emitted)
    assert late.count() > 0
    both = late.select("user_id", "seq").union(counted.select("user_id", "seq"))
    assert rows_of(both) == rows_of(events.select("user_id", "event_id"))


def test_null_readings(spark, events, end, rows_of):
    path = scratch_path(spark, "null-readings")
    holed = events.withColumn("value", F.when(F.col("event_id") % 5 != 0, F.col("value")))
    holed.repartition(3, "event_id").write.parquet(path)
    rows, until = readings(spark, path, events.schema), end + F.expr("interval 2 milliseconds")
    jumps = state.on_time(processed(rows, state.JumpAlert(20.0), until, "40 days"))
    twin = alerts.jump(holed, ["user_id"], ORDER, "value", 20.0)
    assert rows_of(jumps) == rows_of(twin.select("user_id", "event_id", "previous", "value"))
    rises = state.on_time(processed(rows, state.SustainedRise(4 * 3600), until, "40 days"))
    assert rows_of(rises) == rows_of(alerts.sustained_rise(holed, "user_id", ORDER, "value", 4 * 3600, until=end))


def test_upsert_over_batches(spark, events, in_order, rows_of):
    path = scratch_path(spark, "t-upsert")
    rows = stream_of(spark, in_order, events.schema).select("user_id", "ts", "event_id", "value")
    each_batch(rows, "t-upsert", sinks.upsert_sink(path, "user_id", ORDER))
    last = events.groupBy("user_id").agg(F.max_by("value", "event_id"))
    current = sinks.read_upserts(spark, path, "user_id", ORDER)
    assert rows_of(current.select("user_id", "value")) == rows_of(last)
    packed = scratch_path(spark, "t-upsert-packed")
    sinks.compact(current, packed)
    again = sinks.read_upserts(spark, packed, "user_id", ORDER)
    assert rows_of(again.select(current.columns)) == rows_of(current)


def test_counters_survive_a_replay(spark, events, rows_of):
    path = scratch_path(spark, "t-replay")
    sink = sinks.counter_sink(path, "user_id", "n")
    counts = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    sink(counts, 0)
    sink(counts, 1)
    sink(counts, 1)
    doubled = counts.withColumn("n", F.col("n") * 2)
    assert rows_of(sinks.read_counters(spark, path, "user_id", "n")) == rows_of(doubled)


def test_restart_goes_on_from_the_checkpoint(spark, events, in_order, rows_of):
    out, checkpoint = scratch_path(spark, "t-restart"), scratch_path(spark, "t-restart-state")
    calls = []
    write = batch_folders(out)

    def breaks_once(df, batch_id):
        calls.append(batch_id)
        write(df, batch_id)
        if batch_id == 2 and calls.count(2) == 1:
            raise RuntimeError("lost after writing")

    rows = stream_of(spark, in_order, events.schema).select("event_id", "value")
    with pytest.raises(Exception, match="lost after writing"):
        each_batch(rows, "t-restart", breaks_once, checkpoint)
    each_batch(rows, "t-restart", breaks_once, checkpoint)
    assert calls == [0, 1, 2, 2, 3]
    stored = read_batches(spark, out, rows.schema)
    assert rows_of(stored.select("event_id", "value")) == rows_of(events.select("event_id", "value"))


def test_attempts_then_failure():
    seen = []

    def fails(df, batch_id):
        seen.append(batch_id)
        raise ValueError("poison")

    with pytest.raises(ValueError, match="poison"):
        sinks.with_attempts(fails, 3)(None, 7)
    assert seen == [7, 7, 7]


def test_ledger_and_resume(spark, rows_of):
    rows = [("a", 0, i, None, "k", "v") for i in range(5)] + [("a", 1, i, None, "k", "v") for i in range(3)]
    messages = spark.createDataFrame(rows, envelope.ENVELOPE)
    read = messages.where("offset < 2 and partition = 0")
    ledger = envelope.next_offsets(read, "g")
    assert rows_of(envelope.save_offsets(ledger, ledger.withColumn("offset", F.lit(1).cast("long")))) == [("a", 0, "g", 2)]
    left = envelope.resume(messages, ledger, "g")
    assert sorted((r.partition, r.offset) for r in left.collect()) == [(0, 2), (0, 3), (0, 4), (1, 0), (1, 1), (1, 2)]
    assert envelope.resume(messages, ledger, "other").count() == 8


def test_strict_json_fails_on_missing_and_broken(spark):
    for bad in ('{"b": 1}', "{", '{"k": "x"}'):
        df = spark.createDataFrame([(bad,)], "value string")
        with pytest.raises(Exception, match="missing|[Mm]alformed|PARSE|FAILFAST"):
            envelope.parse_json_strict(df, "value", "k bigint").collect()


def test_latest_partition(spark):
    path = scratch_path(spark, "t-latest")
    assert_rows = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)], "dt string, v int")
    assert_rows.write.partitionBy("dt").parquet(path)
    assert files.latest_partition(spark, path, "dt") == "2024-01-02"
    latest = files.scan_latest_partition(spark, path, "dt")
    assert sorted(r.v for r in latest.collect()) == [2, 3]


def test_follow_latest_partition_handles_each_once(spark):
    path, seen = scratch_path(spark, "t-follow"), []
    spark.createDataFrame([("a", 1)], "dt string, v int").write.partitionBy("dt").parquet(path)
    ledger = scratch_path(spark, "t-follow-ledger")
    writer = files.follow_latest_partition(spark, path, "dt", lambda df, v: seen.append((v, df.count())), ledger, "1 second")
    query = writer.option("checkpointLocation", scratch_path(spark, "t-follow-state")).start()
    try:
        for _ in range(60):  # ticks never end, so all available input is never processed
            if not seen:
                query.awaitTermination(1)
        spark.createDataFrame([("b", 1), ("b", 2)], "dt string, v int").write.mode("append").partitionBy("dt").parquet(path)
        for _ in range(60):
            if len(seen) < 2:
                query.awaitTermination(1)
    finally:
        query.stop()
    assert seen == [("a", 1), ("b", 2)]


def test_numbers_have_no_gaps_and_survive_replays(spark, rows_of):
    out, ledger = scratch_path(spark, "t-numbers"), scratch_path(spark, "t-numbers-ledger")
    sink = sinks.numbering_sink(out, ledger, "part", ["ts", "id"])
    kind = "id bigint, ts bigint, part string"
    batches = [
        spark.createDataFrame([(i, 100 - i, "ab"[i % 2]) for i in range(10)], kind),
        spark.createDataFrame([(20 + i, i, None if i == 3 else "bc"[i % 2]) for i in range(6)], kind),
        spark.createDataFrame([], kind),
        spark.createDataFrame([(40, 1, "a")], kind),
    ]
    for batch_id, df in enumerate(batches):
        sink(df, batch_id)
    first = rows_of(spark.read.parquet(out))
    for batch_id in (1, 3, 0):  # replays, in any order
        sink(batches[batch_id], batch_id)
    assert rows_of(spark.read.parquet(out)) == first
    numbers = {r["id"]: r["number"] for r in spark.read.parquet(out).collect()}
    order = [8, 6, 4, 2, 0, 9, 7, 5, 3, 1, 23, 20, 22, 24, 21, 25, 40]
    assert [numbers[i] for i in order] == list(range(1, 18))
    counts = {r["part"]: r["seen"] for r in sinks.read_partition_counts(spark, ledger).collect()}
    assert counts == {"a": 6, "b": 8, "c": 2, None: 1}


def test_retractions_over_batches(spark, events, run):
    change = lambda rows: rows.withColumn("kind", F.when(F.col("event_type") != "error", F.col("event_type"))).drop("event_type", "value")
    log = run(state.Retract(), change)
    last = events.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("kind")).where("kind <> 'error'")
    expected = {r["kind"]: r["count"] for r in last.groupBy("kind").count().collect()}
    signed = log.groupBy("kind").agg(F.sum(F.when(F.col("flag") == "+", 1).otherwise(-1)).alias("n"))
    assert {r["kind"]: r["n"] for r in signed.collect() if r["n"]} == expected
