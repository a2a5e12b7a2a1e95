"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.status import POSITIONS, SEVERITY, worst_status
from millrace.functions.text import words
from millrace.operators import aggs, cdc
from millrace.operators.ordered import Running, running
from millrace.plans import shared
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources.tables import load, stream_table
from millrace.streaming import sinks
from millrace.streaming.run import each_batch


@query(
    "cdc_group_count",
    """
SELECT event_type AS kind, count(*) AS counts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events WHERE event_type <> 'view')
WHERE rn = 1 AND event_type <> 'error' GROUP BY event_type""",
)
def cdc_group_count(spark, sf):
    parsed = cdc.parse_canal(shared.canal_messages(spark, sf))
    changes = cdc.change_rows(parsed, {"user_id": "bigint", "kind": "string"})
    return cdc.group_counts(cdc.current_rows(changes, "user_id", ["cdc_id", "cdc_pos"]), "kind")


_HOUR = "date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end"


@query(
    "win_count_distinct",
    f"SELECT {_HOUR}, count(DISTINCT event_type) AS n_distinct FROM events GROUP BY ALL",
)
def win_count_distinct(spark, sf):
    return aggs.window_distinct(load(spark, sf, "events"), "ts", "1 hour", [], "event_type")


@query(
    "win_bitmap_distinct",
    "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end, count(DISTINCT user_id) AS n_distinct FROM events GROUP BY ALL",
)
def win_bitmap_distinct(spark, sf):
    return aggs.window_bitmap_distinct(load(spark, sf, "events"), "ts", "1 day", "user_id")


_VISITOR = "concat('visitor-', cast((event_id * 7919) % 3000 as string))"


@query(
    "win_sketch_distinct",
    """
SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, count(DISTINCT visitor) AS n_distinct, true AS is_close FROM (
  SELECT (event_id * 7919) % 3000 AS visitor, unnest([time_bucket(INTERVAL '1 day', ts) - to_days(i) FOR i IN [0, 1, 2, 3, 4, 5, 6]]) AS window_start
  FROM events) GROUP BY ALL""",
)
def win_sketch_distinct(spark, sf):
    """Sketches of daily panes merged into weeks, held against exact counts: within three standard errors."""
    rows = load(spark, sf, "events").select("ts", F.expr(_VISITOR).alias("visitor"))
    about = aggs.sliding_sketch_distinct(rows, "ts", "7 days", "1 day", [], "visitor")
    exact = aggs.sliding(rows, "ts", "7 days", "1 day", [], [F.count_distinct("visitor").alias("n_distinct")])
    off = F.abs(F.col("n_about") - F.col("n_distinct"))
    return about.join(exact, ["window_start", "window_end"]).select(
        "window_start", "window_end", "n_distinct", (off <= 3 * aggs.sketch_error() * F.col("n_distinct")).alias("is_close")
    )


@query("reduce_min_latest_ts", "SELECT user_id, min(value) AS min_value, max(ts) AS latest_ts FROM events GROUP BY 1")
def reduce_min_latest_ts(spark, sf):
    return load(spark, sf, "events").groupBy("user_id").agg(
        F.min("value").alias("min_value"), F.max_by("ts", F.struct("ts", "event_id")).alias("latest_ts")
    )


@query(
    "reduce_running_min",
    """SELECT event_id, user_id, min(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS min_so_far FROM events""",
)
def reduce_running_min(spark, sf):
    spec = {"min_so_far": Running("min", F.col("value"))}
    out = running(load(spark, sf, "events"), ["user_id"], ["ts", "event_id"], spec)
    return out.select("event_id", "user_id", "min_so_far")


@query("win_sum", f"SELECT {_HOUR}, user_id, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def win_sum(spark, sf):
    total = F.round(F.sum("value"), 2).alias("total")
    return aggs.tumbling(load(spark, sf, "events"), "ts", "1 hour", ["user_id"], [total])


WIN_MIN_BY_SQL = f"""
SELECT window_start, window_end, user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start, user_id ORDER BY value, ts, event_id) AS rn
  FROM (SELECT *, {_HOUR} FROM events)) WHERE rn = 1"""


@query("win_min_by", WIN_MIN_BY_SQL)
def win_min_by(spark, sf):
    row = aggs.first_min_row("value", ["ts", "event_id"], ["event_id", "value"]).alias("row")
    out = aggs.tumbling(load(spark, sf, "events"), "ts", "1 hour", ["user_id"], [row])
    return out.select("window_start", "window_end", "user_id", "row.*")


@query("win_count", f"SELECT {_HOUR}, user_id, count(*) AS n FROM events GROUP BY ALL")
def win_count(spark, sf):
    return aggs.tumbling(load(spark, sf, "events"), "ts", "1 hour", ["user_id"], [shared.n_rows()])


@query(
    "win_sliding_count",
    """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n FROM (
  SELECT event_type, unnest([time_bucket(INTERVAL '15 minutes', ts) - to_minutes(15 * i) FOR i IN [0, 1, 2, 3]]) AS window_start FROM events)
GROUP BY ALL""",
)
def win_sliding_count(spark, sf):
    return aggs.sliding(
        load(spark, sf, "events"), "ts", "1 hour", "15 minutes", ["event_type"], [shared.n_rows()]
    )


@query(
    "win_session",
    """
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS n FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 2 HOUR
                   THEN 0 ELSE 1 END AS fresh FROM events))
GROUP BY user_id, sid""",
)
def win_session(spark, sf):
    events = load(spark, sf, "events").select("user_id", "ts", "event_id")
    return aggs.sessions(events, ["user_id"], ["ts", "event_id"], "2 hours", [shared.n_rows()])


COUNT_WINDOW_SQL = f"""
SELECT user_id, rn // 2 AS window_no, CAST(sum(k) // 2 AS DOUBLE) AS avg_value FROM (
  SELECT user_id, {shared.K_SQL} AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn FROM events)
GROUP BY user_id, rn // 2 HAVING count(*) = 2"""


@query("count_window_avg", COUNT_WINDOW_SQL)
def count_window_avg(spark, sf):
    return aggs.count_window_avg(shared.events_k(spark, sf), ["user_id"], ["ts", "event_id"], "k", 2)


@query(
    "count_window_sliding",
    f"""
SELECT user_id, rn AS window_end_row, total, n FROM (
  SELECT user_id, row_number() OVER w AS rn,
         CAST(sum({shared.K_SQL}) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS BIGINT) AS total,
         count(*) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS n
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE rn % 2 = 0""",
)
def count_window_sliding(spark, sf):
    rows = shared.events_k(spark, sf).select("user_id", "ts", "event_id", "k")
    panes = {"total": F.sum("k"), "n": F.count(F.lit(1))}
    totals = [F.sum("total").alias("total"), F.sum("n").alias("n")]
    return aggs.count_window_sliding(rows, ["user_id"], ["ts", "event_id"], 10, 2, totals, partial=panes)


_WORDS_SQL = """SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split(regexp_replace("text", ' +$', ''), ' ')) AS word FROM documents) GROUP BY word"""


@query("word_count", _WORDS_SQL)
def word_count(spark, sf):
    return aggs.word_count(load(spark, sf, "documents"), "text")


@query("word_count_running", _WORDS_SQL)
def word_count_running(spark, sf):
    """Counts of each micro-batch are added to a keyed table."""
    path = scratch_path(spark, "word-totals")
    stream = stream_table(spark, sf, "documents")

    def count(df, batch_id):
        sinks.counter_sink(path, "word", "n")(aggs.word_count(df, "text"), batch_id)

    each_batch(stream, "word-totals", count)
    return sinks.read_counters(spark, path, "word", "n")


@query("salted_count", _WORDS_SQL)
def salted_count(spark, sf):
    exploded = load(spark, sf, "documents").select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    return aggs.salted_agg(
        exploded, ["word"], {"n": shared.n_rows()}, {"n": F.sum("n")}, salts=16, salt_on=["doc_id", "pos"]
    )


_SEVERITY_SQL = "'" + SEVERITY + "'"
PAS_STATUS_SQL = (
    "SELECT l_orderkey, "
    + " || ".join(
        f"substr({_SEVERITY_SQL}, max(greatest(instr({_SEVERITY_SQL}, substr(s, {i}, 1)), 1)), 1)"
        for i in range(1, POSITIONS + 1)
    )
    + f" AS status24 FROM (SELECT l_orderkey, {shared.STATUS_SQL} AS s FROM lineitem) GROUP BY l_orderkey"
)


@query("pas_status24", PAS_STATUS_SQL)
def pas_status24(spark, sf):
    rows = load(spark, sf, "lineitem").select("l_orderkey", shared.status_text().alias("s"))
    return rows.groupBy("l_orderkey").agg(worst_status("s").alias("status24"))


@query("doc_max", "SELECT max(c_acctbal) AS max_acctbal FROM customer")
def doc_max(spark, sf):
    return load(spark, sf, "customer").agg(F.max("c_acctbal").alias("max_acctbal"))


@query(
    "doc_terms_top10",
    """SELECT p_brand AS "key", count(*) AS doc_count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def doc_terms_top10(spark, sf):
    return aggs.top_terms(load(spark, sf, "part"), "p_brand", 10)
