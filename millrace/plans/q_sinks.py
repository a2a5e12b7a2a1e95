"""Sinks: each query writes, reads back, and returns what is stored."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.dates import date_partition
from millrace.operators import committed, cdc, cells, search
from millrace.operators.joins import last_per_key
from millrace.plans import shared
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources import envelope, files
from millrace.sources.tables import load, stream_table
from millrace.streaming import sinks
from millrace.streaming.run import batch_folders, each_batch


def _stored(df, label):
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@query(
    "to_envelope_json",
    """
SELECT event_type AS topic, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"value":'
       || CAST(value AS VARCHAR) || ',"props":"' || replace(props, '"', '\\"') || '"}' AS "value" FROM events""",
)
def to_envelope_json(spark, sf):
    events = load(spark, sf, "events")
    value = envelope.json_value(events, ["event_id", "user_id", "value", "props"])
    return _stored(events.select(F.col("event_type").alias("topic"), value.alias("value")), "topic")


_LAST_EVENT_SQL = """
SELECT user_id, event_id, event_type, value FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


@query("keyed_upsert", _LAST_EVENT_SQL)
def keyed_upsert(spark, sf):
    path = scratch_path(spark, "upserts")
    stream = stream_table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    each_batch(stream, "upserts", sinks.upsert_sink(path, "user_id", ["ts", "event_id"]))
    return sinks.read_upserts(spark, path, "user_id", ["ts", "event_id"]).drop("ts")


@query(
    "latest_value_per_key",
    f"""SELECT event_type AS "table", "key", value FROM (
SELECT event_type, CAST(user_id AS VARCHAR) AS "key", value,
       row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
)
def latest_value_per_key(spark, sf):
    rows = load(spark, sf, "events").select(
        F.col("event_type").alias("table"), F.col("user_id").cast("string").alias("key"), "ts", "event_id", "value"
    )
    latest = last_per_key(rows, ["table", "key"], ["ts", "event_id"])
    return _stored(latest.select("table", "key", "value"), "hash-table")


@query(
    "csv_to_cells",
    """
SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS row_key, 'cf1' AS family, qualifier, value, ts
FROM (SELECT o_custkey, 'status' AS qualifier, o_orderstatus AS value, o_orderkey AS ts FROM orders
      UNION ALL SELECT o_custkey, 'priority', o_orderpriority, o_orderkey FROM orders)""",
)
def csv_to_cells(spark, sf):
    line = F.concat_ws(",", shared.row_key(F.col("o_custkey")), "o_orderstatus", "o_orderpriority")
    lines = load(spark, sf, "orders").select(line.alias("line"), F.col("o_orderkey").alias("at"))
    return _stored(cells.csv_to_cells(lines, "line", "cf1", ["status", "priority"], F.col("at")), "cells")


@query(
    "cell_update",
    f"""
WITH {shared.CELLS_CTE}
SELECT row_key, family, qualifier,
       CASE WHEN qualifier = 'balance' AND row_key IN
         (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') FROM customer WHERE c_mktsegment = 'BUILDING')
       THEN '0.00' ELSE value END AS value
FROM latest""",
)
def cell_update(spark, sf):
    customer = load(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    changes = customer.select(
        shared.row_key(F.col("c_custkey")).alias("row_key"),
        F.lit("fin").alias("family"),
        F.lit("balance").alias("qualifier"),
        F.lit("0.00").alias("value"),
        F.lit(1).cast("long").alias("ts"),
    )
    return cells.update(shared.cells(spark, sf), changes).drop("ts")


@query(
    "cell_delete",
    f"""
WITH {shared.CELLS_CTE}, c AS (SELECT *, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS rk FROM customer)
SELECT row_key, family, qualifier, value, ts FROM cells
WHERE row_key NOT IN (SELECT rk FROM c WHERE c_mktsegment = 'BUILDING')
  AND NOT (family = 'ord' AND row_key IN (SELECT rk FROM c WHERE c_mktsegment = 'FURNITURE'))
  AND NOT (family = 'info' AND qualifier = 'segment' AND row_key IN (SELECT rk FROM c WHERE c_mktsegment = 'MACHINERY'))""",
)
def cell_delete(spark, sf):
    customer = load(spark, sf, "customer")
    rule = {"BUILDING": (None, None), "FURNITURE": ("ord", None), "MACHINERY": ("info", "segment")}
    family, qualifier = F.lit(None).cast("string"), F.lit(None).cast("string")
    for segment, (f, q) in rule.items():
        here = F.col("c_mktsegment") == segment
        family = F.when(here, F.lit(f)).otherwise(family)
        qualifier = F.when(here, F.lit(q)).otherwise(qualifier)
    tombstones = customer.where(F.col("c_mktsegment").isin(*rule)).select(
        shared.row_key(F.col("c_custkey")).alias("row_key"),
        family.alias("family"),
        qualifier.alias("qualifier"),
    )
    return cells.delete(shared.cells(spark, sf), tombstones)


@query(
    "cell_max_versions",
    f"""
WITH {shared.CELLS_CTE}
SELECT * FROM (SELECT row_key, family, qualifier, value, ts,
  row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC) AS version FROM cells)
WHERE version <= 2""",
)
def cell_max_versions(spark, sf):
    return cells.keep_versions(shared.cells(spark, sf), 2)


@query(
    "doc_index_bulk",
    """
SELECT c_custkey AS _id, coalesce(w.name, c_name) AS name, coalesce(w.amount, c_acctbal) AS amount
FROM customer LEFT JOIN (
  SELECT o_custkey, arg_max('order-' || o_orderkey, o_orderkey) AS name, arg_max(o_totalprice, o_orderkey) AS amount
  FROM orders GROUP BY o_custkey) w ON o_custkey = c_custkey""",
)
def doc_index_bulk(spark, sf):
    base = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount")
    )
    writes = load(spark, sf, "orders").select(
        F.col("o_custkey").alias("_id"),
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderkey").alias("seq"),
    )
    return search.index_documents(base, writes, "_id", ["seq"])


@query(
    "doc_partial_update",
    """
SELECT c_custkey, c_name, coalesce(p.best, c_acctbal) AS c_acctbal, c_mktsegment
FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS best FROM orders GROUP BY 1) p ON o_custkey = c_custkey""",
)
def doc_partial_update(spark, sf):
    patch = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("c_acctbal")
    )
    base = load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return search.update_documents(base, patch, "c_custkey")


@query(
    "doc_delete_bulk",
    """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')""",
)
def doc_delete_bulk(spark, sf):
    ids = load(spark, sf, "orders").where("o_orderstatus = 'P' and o_orderpriority = '1-URGENT'")
    base = load(spark, sf, "customer").select("c_custkey", "c_name")
    return search.delete_documents(base, ids.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query(
    "cdc_merge",
    """
SELECT user_id, event_id, event_type AS kind, strftime(ts, '%Y-%m-%d') AS dt FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'error'""",
)
def cdc_merge(spark, sf):
    """A table of the first half month, then the second half merged in as one micro-batch."""
    path = scratch_path(spark, "merged")
    op = F.when(F.col("event_type") == "error", "delete").otherwise("upsert")
    changes = load(spark, sf, "events").select(
        "user_id",
        "event_id",
        F.col("event_type").alias("kind"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        op.alias("op"),
    )
    first = cdc.current_rows(changes.where(F.col("dt") < shared.SPLIT_DAY), "user_id", ["event_id"])
    cdc.overwrite_partitions(first, path, ["dt"])
    second = changes.where(F.col("dt") >= shared.SPLIT_DAY)
    sinks.cdc_sink(path, "user_id", ["event_id"], "dt")(second, 0)
    return files.read_partitioned(spark, path, "dt")


@query(
    "cdc_merge_edge_partitions",
    """
SELECT user_id, event_id, event_type AS kind, CASE WHEN hour(ts) >= 6 THEN strftime(ts, '%H') END AS h FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'error'""",
)
def cdc_merge_edge_partitions(spark, sf):
    """Zero-padded and null partition values; the first batch creates the table, the second merges."""
    path = scratch_path(spark, "merged-edge")
    op = F.when(F.col("event_type") == "error", "delete").otherwise("upsert")
    hour = F.when(F.hour("ts") >= 6, F.date_format("ts", "HH"))
    changes = load(spark, sf, "events").select(
        "user_id", "event_id", F.col("event_type").alias("kind"), hour.alias("h"), op.alias("op"),
        F.date_format("ts", "yyyy-MM-dd").alias("cdc_day"),
    )
    sink = sinks.cdc_sink(path, "user_id", ["event_id"], "h")
    sink(changes.where(F.col("cdc_day") < shared.SPLIT_DAY), 0)
    sink(changes.where(F.col("cdc_day") >= shared.SPLIT_DAY), 1)
    return files.read_partitioned(spark, path, "h")


_HALVES = "user_id bigint, event_id bigint, kind string, dt string"


@query(
    "cdc_merge_indexed",
    """
SELECT user_id, event_id, event_type AS kind, strftime(ts, '%Y-%m-%d') AS dt FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'error'""",
)
def cdc_merge_indexed(spark, sf):
    """Two micro-batches merged into a table that knows which files may hold a key; the second comes twice."""
    op = F.when(F.col("event_type") == "error", "delete").otherwise("upsert")
    changes = load(spark, sf, "events").select(
        "user_id", "event_id", F.col("event_type").alias("kind"), F.date_format("ts", "yyyy-MM-dd").alias("dt"), op.alias("op")
    )
    users = changes.agg(F.approx_count_distinct("user_id")).first()[0]
    table = committed.Table(spark, scratch_path(spark, "indexed"), "user_id", "dt", _HALVES, committed.slots_for(users))
    sink = committed.merge_sink(table, ["event_id"])
    halves = [changes.where(F.col("dt") < shared.SPLIT_DAY), changes.where(F.col("dt") >= shared.SPLIT_DAY)]
    for batch_id in (0, 1, 1):
        sink(halves[batch_id], batch_id)
    return table.read()


@query("two_phase_sink", "SELECT event_id, user_id, value FROM events")
def two_phase_sink(spark, sf):
    """Micro-batches as transactions; each is cut off before its commit, recovered, and delivered again."""
    kind = "event_id bigint, user_id bigint, value double, part int"
    table = committed.Table(spark, scratch_path(spark, "two-phase"), "event_id", "part", kind)

    def cut_off(df, batch_id):
        txn = f"batch-{batch_id}"
        table.pre_commit(txn, table.stage(df, txn))
        table.recover()
        committed.two_phase_sink(table)(df, batch_id)

    rows = stream_table(spark, sf, "events").select("event_id", "user_id", "value", F.pmod("user_id", F.lit(4)).cast("int").alias("part"))
    each_batch(rows, "two-phase", cut_off)
    return table.read().drop("part")


@query(
    "partition_date_derive",
    """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN '9999/12/30' ELSE strftime(o_orderdate, '%Y/%m/%d') END AS part
FROM orders""",
)
def partition_date_derive(spark, sf):
    text = (
        F.when(F.col("o_orderpriority") == "5-LOW", " ")
        .when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )
    orders = load(spark, sf, "orders").select("o_orderkey", text.alias("day"))
    return orders.select("o_orderkey", date_partition(F.col("day")).alias("part"))


@query(
    "insert_overwrite_partition",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE o_orderpriority END AS note, o_orderstatus FROM orders""",
)
def insert_overwrite_partition(spark, sf):
    path = scratch_path(spark, "by-status")
    orders = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("note"), "o_orderstatus")
    cdc.overwrite_partitions(orders, path, ["o_orderstatus"])
    closed = orders.where("o_orderstatus = 'F'").withColumn("note", F.lit("closed"))
    cdc.overwrite_partitions(closed, path, ["o_orderstatus"])
    return spark.read.parquet(path)


@query(
    "copy_selected_columns",
    f"""
WITH {shared.CELLS_CTE} SELECT row_key, family, qualifier, value FROM cells
WHERE family = 'info' AND qualifier IN ('name', 'segment')""",
)
def copy_selected_columns(spark, sf):
    source = shared.cells(spark, sf)
    return _stored(cells.copy_columns(source, "info", ["name", "segment"]).drop("ts"), "copied")


_SNAPSHOT_SQL = """
SELECT user_id, event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events {where})
WHERE rn = 1"""
_CHANGELOG_SQL = f"""
WITH o AS ({_SNAPSHOT_SQL.format(where=f"WHERE ts < TIMESTAMP '{shared.SPLIT_DAY} 00:00:00'")}),
n AS ({_SNAPSHOT_SQL.format(where="")})
SELECT '-' AS flag, * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.user_id = o.user_id AND n.event_id = o.event_id)
UNION ALL
SELECT '+' AS flag, * FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE n.user_id = o.user_id AND n.event_id = o.event_id)"""


def _changelog(spark, sf):
    rows = load(spark, sf, "events").select("user_id", "event_type", "event_id", "ts")
    before = last_per_key(rows.where(F.col("ts") < shared.SPLIT_DAY), ["user_id"], ["event_id"]).drop("ts")
    after = last_per_key(rows, ["user_id"], ["event_id"]).drop("ts")
    return cdc.changelog(before, after, "user_id")


@query("changelog_retract_rows", _CHANGELOG_SQL)
def changelog_retract_rows(spark, sf):
    return _changelog(spark, sf)


@query(
    "changelog_group_deltas",
    f"""SELECT event_type, CAST(sum(CASE flag WHEN '+' THEN 1 ELSE -1 END) AS BIGINT) AS counts
FROM ({_CHANGELOG_SQL}) GROUP BY event_type HAVING sum(CASE flag WHEN '+' THEN 1 ELSE -1 END) <> 0""",
)
def changelog_group_deltas(spark, sf):
    return cdc.group_counts_from_log(_changelog(spark, sf), "event_type")


@query("idempotent_batch_sink", "SELECT event_id, user_id, value FROM events")
def idempotent_batch_sink(spark, sf):
    """The same micro-batch is delivered twice; the table holds its rows once."""
    path = scratch_path(spark, "idempotent")
    sink = batch_folders(path)

    def twice(df, batch_id):
        sink(df, batch_id)
        sink(df, batch_id)

    each_batch(stream_table(spark, sf, "events").select("event_id", "user_id", "value"), "idempotent", twice)
    return spark.read.parquet(path).drop("batch_id")


@query(
    "offset_ledger",
    f"""
SELECT topic, "partition", 'loader' AS group_id, max("offset") + 1 AS "offset" FROM ({shared.ENVELOPE_SQL}) GROUP BY ALL""",
)
def offset_ledger(spark, sf):
    path, ledger, out = (scratch_path(spark, p) for p in ("envelope", "ledger", "loaded"))
    messages = shared.envelope(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    messages.write.parquet(path)
    sink = sinks.ledger_sink(ledger, "loader", batch_folders(out))
    each_batch(envelope.read_envelope_files(spark, path), "ledger", sinks.with_attempts(sink))
    return sinks.read_ledger(spark, ledger)


def _broken_stream(spark, sf):
    cut = F.expr("substr(props, 1, length(props) - 1)")
    value = F.when(F.col("event_type") == "error", cut).otherwise(F.col("props"))
    return stream_table(spark, sf, "events").select(
        "event_id", value.alias("payload"), F.col("value").alias("amount")
    )


@query(
    "quarantine_rows",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'bad_json' ELSE 'too_large' END AS reason
FROM events WHERE event_type = 'error' OR value >= 100""",
)
def quarantine_rows(spark, sf):
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "quarantine")
    parsed = F.from_json(
        "payload", "k bigint, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}
    )
    checks = {"bad_json": parsed["_corrupt"].isNull(), "too_large": F.col("amount") < 100}
    each_batch(_broken_stream(spark, sf), "quarantine", sinks.quarantine_sink(good, bad, checks))
    return spark.read.parquet(bad).select("event_id", "reason")
