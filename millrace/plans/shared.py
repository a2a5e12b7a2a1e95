"""Inputs that several queries derive from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.cells import to_cells
from millrace.sources.envelope import json_value, to_envelope
from millrace.sources.tables import load

SPLIT_DAY = "2024-01-16"

K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def n_rows() -> Column:
    return F.count(F.lit(1)).alias("n")


def events_k(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the integer reading k."""
    return load(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))


def envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Events as messages: topic = type, four partitions, offset = id."""
    events = load(spark, sf, "events")
    return to_envelope(
        events,
        topic=F.col("event_type"),
        partition=F.pmod("user_id", F.lit(4)),
        offset=F.col("event_id"),
        ts=F.col("ts"),
        key=F.col("user_id"),
        value=json_value(events, ["event_id", "user_id", "event_type", "value"]),
    )


ENVELOPE_SQL = """
SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
       ts AS "timestamp", CAST(user_id AS VARCHAR) AS "key",
       '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type
       || '","value":' || CAST(value AS VARCHAR) || '}' AS "value"
FROM events"""


def canal_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as change messages of two tables; views are messages that change no row."""
    return canal_messages_of(load(spark, sf, "events"))


def canal_messages_of(events: DataFrame) -> DataFrame:
    kind = (
        F.when(F.col("event_type") == "signup", "INSERT")
        .when(F.col("event_type") == "error", "DELETE")
        .when(F.col("event_type") == "view", "QUERY")
        .otherwise("UPDATE")
    )
    row = F.create_map(
        F.lit("USER_ID"), F.col("user_id").cast("string"),
        F.lit("Kind"), F.col("event_type"),
        F.lit("day"), F.date_format("ts", "yyyy-MM-dd"),
    )
    message = F.struct(
        F.when(F.col("event_type") == "click", "click_log").otherwise("user_state").alias("table"),
        kind.alias("type"),
        F.array(row).alias("data"),
        F.lit("shop").alias("database"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("es"),
        F.col("event_id").alias("id"),
        F.lit(False).alias("isDdl"),
    )
    return events.select(F.to_json(message).alias("value"))


CANAL_CTE = """
canal AS (
  SELECT 'shop' AS "database",
         CASE WHEN event_type = 'click' THEN 'click_log' ELSE 'user_state' END AS "table",
         CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op,
         event_id AS id, user_id, event_type AS kind, strftime(ts, '%Y-%m-%d') AS "day"
  FROM events WHERE event_type <> 'view')"""


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and their orders as wide-column cells; each order is a new version."""
    customer, orders = load(spark, sf, "customer"), load(spark, sf, "orders")
    facts = to_cells(
        customer.withColumn("balance", F.col("c_acctbal").cast("decimal(15,2)")),
        row_key(F.col("c_custkey")),
        {
            "c_name": ("info", "name"),
            "c_mktsegment": ("info", "segment"),
            "balance": ("fin", "balance"),
        },
        F.lit(0).cast("long"),
    )
    versions = to_cells(
        orders,
        row_key(F.col("o_custkey")),
        {"o_orderstatus": ("ord", "status"), "o_orderpriority": ("ord", "priority")},
        F.col("o_orderkey") + 1,
    )
    return facts.unionByName(versions)


def row_key(c: Column) -> Column:
    return F.lpad(c.cast("string"), 10, "0")


CELLS_CTE = """
cells AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS row_key, family, qualifier, value, CAST(0 AS BIGINT) AS ts
  FROM (SELECT c_custkey, 'info' AS family, 'name' AS qualifier, c_name AS value FROM customer
        UNION ALL SELECT c_custkey, 'info', 'segment', c_mktsegment FROM customer
        UNION ALL SELECT c_custkey, 'fin', 'balance', CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR) FROM customer)
  UNION ALL
  SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0'), 'ord', qualifier, value, o_orderkey + 1
  FROM (SELECT o_custkey, o_orderkey, 'status' AS qualifier, o_orderstatus AS value FROM orders
        UNION ALL SELECT o_custkey, o_orderkey, 'priority', o_orderpriority FROM orders)),
latest AS (
  SELECT row_key, family, qualifier, arg_max(value, ts) AS value, max(ts) AS ts
  FROM cells GROUP BY ALL)"""


def status_text() -> Column:
    """A 24-character repayment history per line item."""
    digest = F.md5(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    return F.translate(F.substring(digest, 1, 24), "0123456789abcdef", "*NC/#1234567ABDG")


STATUS_SQL = """translate(substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)), 1, 24),
  '0123456789abcdef', '*NC/#1234567ABDG')"""


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Events in a disturbed arrival order, up to two hours late."""
    delay = F.make_dt_interval(secs=F.pmod(F.col("event_id") * 7919, F.lit(7200)))
    return load(spark, sf, "events").withColumn("arrival", F.col("ts") + delay)


ARRIVALS_CTE = """
arrivals AS (
  SELECT *, ts + to_seconds((event_id * 7919) % 7200) AS arrival FROM events),
traced AS (
  SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) - INTERVAL 2 SECOND AS watermark,
         date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end
  FROM arrivals),
late AS (
  SELECT *, window_end + INTERVAL 60 SECOND <= watermark AS is_late FROM traced)"""
