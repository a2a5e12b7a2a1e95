"""Joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import joins
from millrace.plans.registry import query
from millrace.sources.tables import load, stream_table
from millrace.streaming.run import drain


def _outside_europe(spark, sf):
    nation, region = load(spark, sf, "nation"), load(spark, sf, "region")
    here = nation.join(region.where("r_name <> 'EUROPE'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return here.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")


@query(
    "join_broadcast_left",
    """
SELECT c_custkey, c_nationkey, n_name, r_name FROM customer LEFT JOIN (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'EUROPE')
ON n_nationkey = c_nationkey""",
)
def join_broadcast_left(spark, sf):
    customer = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return joins.broadcast_left(customer, _outside_europe(spark, sf), ["c_nationkey"], ["c_nationkey"])


@query(
    "join_inner",
    """
SELECT o_orderpriority, l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL""",
)
def join_inner(spark, sf):
    items = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_returnflag", "l_quantity")
    orders = load(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderpriority")
    return (
        joins.inner_shuffled(items, orders, ["orderkey"])
        .groupBy("o_orderpriority", "l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))
    )


_ASOF = """
SELECT p.event_id, p.user_id, p.value, s.event_id AS version_id, s.value AS version_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF {how} JOIN
     (SELECT * FROM events WHERE event_type = 'signup') s ON s.user_id = p.user_id AND s.ts <= p.ts"""


def _asof(spark, sf, how):
    events = load(spark, sf, "events")
    left = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    versions = events.where("event_type = 'signup'").select("event_id", "user_id", "ts", "value")
    columns = {"version_id": "event_id", "version_value": "value"}
    return joins.asof_join(left, versions, ["user_id"], "ts", "ts", columns, ["event_id"], how).drop("ts")


@query("asof_join_inner", _ASOF.format(how=""))
def asof_join_inner(spark, sf):
    return _asof(spark, sf, "inner")


@query("asof_join_left", _ASOF.format(how="LEFT"))
def asof_join_left(spark, sf):
    return _asof(spark, sf, "left")


@query(
    "lookup_inner",
    "SELECT event_id, s_suppkey, s_name FROM events JOIN supplier ON s_suppkey = user_id",
)
def lookup_inner(spark, sf):
    """Stream rows looked up in a static table; misses are dropped."""
    clicks = stream_table(spark, sf, "events").select("event_id", F.col("user_id").alias("s_suppkey"))
    found = joins.lookup(clicks, load(spark, sf, "supplier"), ["s_suppkey"], ["s_name"])
    return drain(found, "lookup")


@query(
    "lookup_enrich_ordered",
    "SELECT event_id, user_id, value, s_name AS docs FROM events JOIN supplier ON s_suppkey = user_id ORDER BY event_id",
)
def lookup_enrich_ordered(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id", "value")
    dim = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("docs"))
    return joins.lookup(events, dim, ["user_id"], ["docs"]).orderBy("event_id")


@query(
    "lookup_left",
    """
SELECT event_id, user_id, activity FROM events LEFT JOIN (
  SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS activity FROM orders GROUP BY o_custkey)
ON o_custkey = user_id""",
)
def lookup_left(spark, sf):
    """Several orders per customer: the last one gives the name; no order gives null."""
    events = load(spark, sf, "events").select("event_id", "user_id")
    dim = load(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("activity"), "o_orderkey"
    )
    return joins.lookup(events, dim, ["user_id"], ["activity"], "left", order=["o_orderkey"])


def _dictionary(spark, sf):
    nation = load(spark, sf, "nation").select(
        F.lit("NATION").alias("family"), F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label")
    )
    region = load(spark, sf, "region").select(
        F.lit("REGION").alias("family"), F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("label")
    )
    return joins.code_dictionary(nation.unionByName(region))


@query(
    "decode_codes",
    """
SELECT s_suppkey, nation, region, n_name AS nation_label, r_name AS region_label
FROM (SELECT s_suppkey, s_nationkey AS nation, s_nationkey % 7 AS region FROM supplier)
LEFT JOIN nation ON n_nationkey = nation LEFT JOIN region ON r_regionkey = region""",
)
def decode_codes(spark, sf):
    """Regions 5 and 6 are not in the dictionary and decode to null."""
    rows = load(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("nation"), (F.col("s_nationkey") % 7).alias("region")
    )
    return joins.decode_codes(rows, _dictionary(spark, sf), {"nation": "NATION", "region": "REGION"})


@query(
    "encode_labels",
    """
SELECT c_custkey, n_name, CAST(n_nationkey AS VARCHAR) AS n_name_code
FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def encode_labels(spark, sf):
    nation = load(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = load(spark, sf, "customer").join(nation, "c_nationkey").select("c_custkey", "n_name")
    return joins.encode_labels(rows, _dictionary(spark, sf), {"n_name": "NATION"})
