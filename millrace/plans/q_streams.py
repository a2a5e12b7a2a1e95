"""Event time, keyed state and alerts, as streams and as batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggs, alerts, cdc, routing
from millrace.operators.ordered import row_numbers
from millrace.plans import shared
from millrace.plans.q_aggregates import COUNT_WINDOW_SQL, WIN_MIN_BY_SQL
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources.tables import load, stream_table, timestamp_to_ntz
from millrace.streaming import keyed_state as state
from millrace.streaming import sinks
from millrace.streaming.run import drain, drain_until, each_batch

ORDER = ["ts", "event_id"]

#: How far apart in time the files of a table may be read: rows wait that long in state. It spans the
#: tables, so that files may come in any order; a feed that arrives about in time order needs far less.
DELAY = "31 days"
#: Waiting rows are read and rewritten by buckets of this size, a part of the delay.
BUCKET_SECONDS = 4 * 86_400


@query(
    "stream_tumbling_append",
    f"SELECT * FROM ({WIN_MIN_BY_SQL}) WHERE window_end <= (SELECT max(ts) - INTERVAL 2 SECOND FROM events)",
)
def stream_tumbling_append(spark, sf):
    """Only windows the watermark has passed are emitted."""

    def windows(rows):
        row = aggs.first_min_row("value", ORDER, ["event_id", "value"]).alias("row")
        out = aggs.tumbling(rows, "ts", "1 hour", ["user_id"], [row])
        return out.select("window_start", "window_end", "user_id", "row.*")

    until = _end(spark, sf) - F.expr("interval 2 seconds")
    return timestamp_to_ntz(drain_until(stream_table(spark, sf, "events"), "ts", DELAY, until, windows, "tumbling"))


@query(
    "stream_window_updates",
    """
SELECT date_trunc('hour', ts) AS window_start, count(*) AS n FROM events GROUP BY 1""",
)
def stream_window_updates(spark, sf):
    """Update mode with lateness added to the delay: every update re-fires its window."""
    stream = stream_table(spark, sf, "events").withWatermark("ts", "62 seconds")
    out = aggs.tumbling(stream, "ts", "1 hour", [], [shared.n_rows()]).drop("window_end")
    fired = drain(out, "updates", "update")
    last = fired.groupBy("window_start").agg(F.max_by("n", "batch_id").alias("n"))
    return timestamp_to_ntz(last)


@query(
    "watermark_trace",
    f"WITH {shared.ARRIVALS_CTE} SELECT event_id, watermark FROM traced",
)
def watermark_trace(spark, sf):
    rows = shared.arrivals(spark, sf).select("event_id", "ts", "arrival")
    return routing.watermark_trace(rows, ["arrival", "event_id"], "ts", "2 seconds").select("event_id", "watermark")


def _late(spark, sf):
    rows = shared.arrivals(spark, sf).select("event_id", "user_id", "ts", "arrival", "value")
    return routing.with_lateness(rows, ["arrival", "event_id"], "ts", "1 hour", "2 seconds", "60 seconds")


@query("late_rows", f"WITH {shared.ARRIVALS_CTE} SELECT event_id, window_end, watermark FROM late WHERE is_late")
def late_rows(spark, sf):
    return _late(spark, sf).where("is_late").select("event_id", "window_end", "watermark")


@query("on_time_rows", f"WITH {shared.ARRIVALS_CTE} SELECT event_id, window_end FROM late WHERE NOT is_late")
def on_time_rows(spark, sf):
    return _late(spark, sf).where("not is_late").select("event_id", "window_end")


@query(
    "win_allowed_lateness",
    f"""WITH {shared.ARRIVALS_CTE}
SELECT window_start, count(*) AS n, count(*) FILTER (window_end <= watermark) AS refires FROM late WHERE NOT is_late GROUP BY 1""",
)
def win_allowed_lateness(spark, sf):
    """Rows that come inside the grace period fire their window once more each."""
    kept = _late(spark, sf).where("not is_late")
    return kept.groupBy("window_start").agg(
        shared.n_rows(), F.count_if(F.col("window_end") <= F.col("watermark")).alias("refires")
    )


@query(
    "stream_late_router",
    f"""
WITH {shared.ARRIVALS_CTE},
seen AS (SELECT max(ts) - INTERVAL 62 SECOND AS closed FROM arrivals WHERE arrival < TIMESTAMP '{shared.SPLIT_DAY} 00:00:00')
SELECT event_id, CASE WHEN arrival >= TIMESTAMP '{shared.SPLIT_DAY} 00:00:00'
  AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= closed THEN 'late' ELSE 'on_time' END AS output FROM arrivals, seen""",
)
def stream_late_router(spark, sf):
    """Two micro-batches, cut by arrival: the second one sees the watermark of the first."""
    source, state_dir, on_time, late, ledger = (
        scratch_path(spark, p) for p in ("arrivals", "late-state", "on-time", "late", "watermarks")
    )
    rows = shared.arrivals(spark, sf).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "arrival")
    handler = sinks.late_router(on_time, late, ledger, "ts", "1 hour", "2 seconds", "60 seconds")
    for half in (F.col("arrival") < shared.SPLIT_DAY, F.col("arrival") >= shared.SPLIT_DAY):
        rows.where(half).select("event_id", "ts").write.mode("append").parquet(source)
        stream = spark.readStream.schema("event_id bigint, ts timestamp").parquet(source)
        each_batch(stream, "late-router", handler, state_dir)
    parts = [
        spark.read.schema("event_id bigint, ts timestamp").parquet(p).select("event_id", F.lit(name).alias("output"))
        for name, p in (("on_time", on_time), ("late", late))
    ]
    return parts[0].unionByName(parts[1])


RUNNING_COUNT_SQL = "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS running FROM events"


@query("keyed_running_count", RUNNING_COUNT_SQL)
def keyed_running_count(spark, sf):
    rows = load(spark, sf, "events").select("user_id", *ORDER)
    return row_numbers(rows, ["user_id"], ORDER, "running").drop("ts")


@query("global_running_count", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS running FROM events")
def global_running_count(spark, sf):
    return row_numbers(load(spark, sf, "events").select(*ORDER), [], ORDER, "running").drop("ts")


_LAST3_SQL = f"""SELECT user_id, string_agg(CAST(k AS VARCHAR), ',' ORDER BY rn DESC) AS last_values FROM (
  SELECT user_id, {{k}} AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn <= 3 GROUP BY user_id"""


@query("keyed_last_n_list", _LAST3_SQL.format(k=shared.K_SQL))
def keyed_last_n_list(spark, sf):
    last = aggs.last_n_values(shared.events_k(spark, sf), ["user_id"], ORDER, "k", 3)
    return last.withColumn("last_values", F.array_join("last_values", ","))


@query("keyed_map_counts", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def keyed_map_counts(spark, sf):
    return load(spark, sf, "events").groupBy("user_id", "event_type").agg(shared.n_rows())


JUMP_SQL = """
SELECT user_id, event_id, previous, value AS current FROM (
  SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
WHERE abs(value - previous) > 20"""


@query("alert_jump", JUMP_SQL)
def alert_jump(spark, sf):
    rows = load(spark, sf, "events").select("user_id", *ORDER, "value")
    jumps = alerts.jump(rows, ["user_id"], ORDER, "value", 20.0)
    return jumps.select("user_id", "event_id", "previous", F.col("value").alias("current"))


SUSTAINED_SQL = """
WITH RECURSIVE r AS (
  SELECT user_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
s AS (
  SELECT user_id, rn, value, CASE WHEN value > 0 THEN ts + INTERVAL 4 HOUR END AS timer, CAST(NULL AS TIMESTAMP) AS fired
  FROM r WHERE rn = 1
  UNION ALL
  SELECT r.user_id, r.rn, r.value,
         CASE WHEN s.timer <= r.ts OR s.timer IS NULL
              THEN CASE WHEN r.value > s.value THEN r.ts + INTERVAL 4 HOUR END
              WHEN r.value < s.value THEN NULL ELSE s.timer END,
         CASE WHEN s.timer <= r.ts THEN s.timer END
  FROM s JOIN r ON r.user_id = s.user_id AND r.rn = s.rn + 1),
ends AS (SELECT user_id, max(rn) AS rn FROM r GROUP BY 1)
SELECT user_id, fired AS alert_at FROM s WHERE fired IS NOT NULL
UNION ALL
SELECT s.user_id, s.timer FROM s JOIN ends USING (user_id, rn) WHERE s.timer <= (SELECT max(ts) FROM events)"""


def _end_of_time(events):
    """How far event time has moved on: one value."""
    return F.lit(events.agg(F.max("ts")).first()[0]).cast(events.schema["ts"].dataType)


@query("alert_sustained_rise", SUSTAINED_SQL)
def alert_sustained_rise(spark, sf):
    events = load(spark, sf, "events")
    return alerts.sustained_rise(events, "user_id", ORDER, "value", 4 * 3600, until=_end_of_time(events))


INACTIVITY_SQL = """
SELECT user_id, ts AS last_ts, ts + INTERVAL 24 HOUR AS alert_at FROM (
  SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events)
WHERE nxt - ts > INTERVAL 24 HOUR OR (nxt IS NULL AND ts + INTERVAL 24 HOUR <= (SELECT max(ts) FROM events))"""


@query("inactivity_timeout", INACTIVITY_SQL)
def inactivity_timeout(spark, sf):
    events = load(spark, sf, "events")
    return alerts.inactivity(events, ["user_id"], ORDER, "24 hours", until=_end_of_time(events))


BLACKLIST_SQL = """
SELECT user_id, event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_day, n FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts + INTERVAL 8 HOUR AS DATE) ORDER BY ts, event_id) AS n FROM events)
WHERE n > 5"""


@query("rate_blacklist", BLACKLIST_SQL)
def rate_blacklist(spark, sf):
    rows = load(spark, sf, "events").select("user_id", *ORDER)
    hits = alerts.rate_blacklist(rows, "user_id", ORDER, 5)
    return hits.select("user_id", "event_id", F.col("local_day").cast("string").alias("local_day"), "n")


def _end(spark, sf):
    return _end_of_time(load(spark, sf, "events"))


def _emitted(spark, sf, processor, label, value="value"):
    """All that a processor emits for the readings of the events, the last of them included."""
    rows = stream_table(spark, sf, "events").select(
        "user_id", F.col("event_id").alias("seq"), "ts", F.expr(value).cast("double").alias("value")
    )
    until = _end(spark, sf) + F.expr("interval 2 milliseconds")  # timers stand at whole milliseconds
    return _processed(rows, until, processor, label)


def _processed(rows, until, processor, label):
    emitted = drain_until(rows, "ts", DELAY, until, lambda r: state.apply_state(r, "user_id", processor, BUCKET_SECONDS), label)
    return state.on_time(emitted)


@query("stream_running_count", RUNNING_COUNT_SQL)
def stream_running_count(spark, sf):
    out = _emitted(spark, sf, state.RunningCount(), "running")
    return out.drop("ts").withColumnRenamed("seq", "event_id")


@query(
    "stream_global_count",
    f"""SELECT event_id, row_number() OVER (
  ORDER BY ts >= TIMESTAMP '{shared.SPLIT_DAY} 00:00:00', CAST(user_id % 4 AS VARCHAR), ts, event_id) AS running FROM events""",
)
def stream_global_count(spark, sf):
    """Numbers over two micro-batches of four partitions each; every batch is delivered twice."""
    source, out, ledger, state_dir = (scratch_path(spark, p) for p in ("parts", "numbered", "numbers", "numbers-state"))
    rows = load(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.pmod("user_id", F.lit(4)).alias("part"))
    sink = sinks.numbering_sink(out, ledger, "part", ORDER, "running")

    def twice(df, batch_id):
        sink(df, batch_id)
        sink(df, batch_id)

    for half in (F.col("ts") < shared.SPLIT_DAY, F.col("ts") >= shared.SPLIT_DAY):
        rows.where(half).write.mode("append").parquet(source)
        each_batch(spark.readStream.schema(rows.schema).parquet(source), "numbers", twice, state_dir)
    return spark.read.parquet(out).select("event_id", "running")


@query(
    "stream_retract_counts",
    """
SELECT event_type AS kind, count(*) AS counts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts) DESC, event_id DESC) AS rn FROM events WHERE event_type <> 'view')
WHERE rn = 1 AND event_type <> 'error' GROUP BY event_type""",
)
def stream_retract_counts(spark, sf):
    """Change messages to signed rows in a stream, and the counts that these add up to."""
    until = _end(spark, sf) + F.expr("interval 2 milliseconds")

    def signed(messages):
        parsed = cdc.parse_canal(messages, keep=("ts",))
        row = F.col("data")[0]
        changes = parsed.select(
            F.try_element_at(row, F.lit("USER_ID")).cast("bigint").alias("user_id"), F.col("cdc_id").alias("seq"), "ts",
            F.when(F.col("op") != "delete", F.try_element_at(row, F.lit("Kind"))).alias("kind"),
        )
        return state.apply_state(changes, "user_id", state.Retract(), BUCKET_SECONDS)

    stream = stream_table(spark, sf, "events")
    messages = shared.canal_messages_of(stream).select("value", F.timestamp_millis(F.get_json_object("value", "$.es").cast("bigint")).alias("ts"))
    log = state.on_time(drain_until(messages, "ts", DELAY, until, signed, "retract"))
    return cdc.group_counts_from_log(log, "kind")


@query("stream_alert_jump", JUMP_SQL)
def stream_alert_jump(spark, sf):
    return _emitted(spark, sf, state.JumpAlert(20.0), "jumps").withColumnRenamed("seq", "event_id")


@query("stream_rate_blacklist", BLACKLIST_SQL)
def stream_rate_blacklist(spark, sf):
    hits = _emitted(spark, sf, state.RateBlacklist(5, 8), "blacklist").withColumnRenamed("seq", "event_id")
    return hits.withColumn("local_day", F.date_format("local_day", "yyyy-MM-dd"))


@query("stream_last_n_list", _LAST3_SQL.format(k=shared.K_SQL))
def stream_last_n_list(spark, sf):
    """The lists of a user come out as time goes on; the last one stands."""
    fired = _emitted(spark, sf, state.LastN(3), "last-n", "cast(get_json_object(props, '$.k') as bigint)")
    last = fired.groupBy("user_id").agg(F.max_by("last_values", F.struct("ts", "seq")).alias("v"))
    texts = F.transform("v", lambda v: v.cast("bigint").cast("string"))
    return last.select("user_id", F.array_join(texts, ",").alias("last_values"))


@query("stream_map_counts", "SELECT user_id, event_type AS kind, count(*) AS n FROM events GROUP BY ALL")
def stream_map_counts(spark, sf):
    """A map of counts per user; counts come out as time goes on, and the last ones stand."""
    rows = stream_table(spark, sf, "events").select("user_id", F.col("event_id").alias("seq"), "ts", F.col("event_type").alias("kind"))
    fired = _processed(rows, _end(spark, sf) + F.expr("interval 2 milliseconds"), state.MapCounts(), "map-counts")
    return fired.groupBy("user_id", "kind").agg(F.max("n").alias("n"))


@query("stream_count_window_avg", COUNT_WINDOW_SQL)
def stream_count_window_avg(spark, sf):
    return _emitted(spark, sf, state.CountWindowAvg(2), "count-window", "cast(get_json_object(props, '$.k') as bigint)")


@query("stream_sustained_rise", SUSTAINED_SQL)
def stream_sustained_rise(spark, sf):
    return timestamp_to_ntz(_emitted(spark, sf, state.SustainedRise(4 * 3600), "rise"))


@query("stream_inactivity", INACTIVITY_SQL)
def stream_inactivity(spark, sf):
    return timestamp_to_ntz(_emitted(spark, sf, state.Inactivity(24 * 3600), "inactivity"))


@query(
    "stream_asof_join",
    """
SELECT p.user_id, p.event_id, s.ts AS version_ts, s.value AS version_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF JOIN
     (SELECT * FROM events WHERE event_type = 'signup') s ON s.user_id = p.user_id AND s.ts <= p.ts
WHERE epoch_us(p.ts) < (SELECT max(epoch_us(ts)) // 1000 * 1000 FROM events)""",
)
def stream_asof_join(spark, sf):
    """Purchases against versions made by sign-ups, emitted once the watermark has passed."""
    rows = stream_table(spark, sf, "events").where("event_type in ('purchase', 'signup')")
    sided = rows.select(
        "user_id",
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("side"),
        F.col("event_id").alias("seq"),
        "ts",
        "value",
    )
    out = _processed(sided, _end(spark, sf), state.AsOfJoin(), "asof")
    return timestamp_to_ntz(out).drop("ts").withColumnRenamed("seq", "event_id")


@query(
    "stream_sessions",
    """
SELECT * FROM (
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS n FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 2 HOUR
                   THEN 0 ELSE 1 END AS fresh FROM events))
GROUP BY user_id, sid) WHERE session_end <= (SELECT max(ts) FROM events)""",
)
def stream_sessions(spark, sf):

    def grouped(rows):
        out = rows.groupBy(F.session_window("ts", "2 hours").alias("w"), "user_id").agg(shared.n_rows())
        return out.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")

    rows = stream_table(spark, sf, "events")
    return timestamp_to_ntz(drain_until(rows, "ts", DELAY, _end(spark, sf), grouped, "sessions"))
