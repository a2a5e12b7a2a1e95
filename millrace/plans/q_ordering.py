"""Sorting, paging, set operations and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import recon, search
from millrace.plans.registry import query
from millrace.sources.tables import load


@query("sort_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_desc(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


@query(
    "page_from_size",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 2 OFFSET 2",
)
def page_from_size(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return search.page(rows, [F.desc("o_totalprice"), F.asc("o_orderkey")], 2, 2)


@query(
    "page_sorted",
    """
SELECT p_partkey, p_retailprice, (SELECT count(*) FROM part WHERE p_type = 'ECONOMY') AS total_hits
FROM part WHERE p_type = 'ECONOMY' ORDER BY p_partkey DESC LIMIT 5 OFFSET 10""",
)
def page_sorted(spark, sf):
    hits = load(spark, sf, "part").where(search.term("p_type", "ECONOMY")).select("p_partkey", "p_retailprice")
    return search.page_with_total(hits, [F.desc("p_partkey")], 2, 5)


@query(
    "page_after_key",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 10",
)
def page_after_key(spark, sf):
    return search.page_after(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 500, 10)


def _parties(spark, sf):
    customer = load(spark, sf, "customer").select(
        F.lit("customer").alias("role"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey")
    )
    supplier = load(spark, sf, "supplier").select(
        F.lit("supplier").alias("role"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey")
    )
    return customer, supplier


@query(
    "union_all",
    """SELECT 'customer' AS role, c_name AS name, c_nationkey AS nationkey FROM customer
UNION ALL SELECT 'supplier', s_name, s_nationkey FROM supplier""",
)
def union_all(spark, sf):
    customer, supplier = _parties(spark, sf)
    return customer.unionByName(supplier)


@query(
    "union_distinct",
    "SELECT l_suppkey AS party FROM lineitem UNION SELECT o_custkey FROM orders",
)
def union_distinct(spark, sf):
    a = load(spark, sf, "lineitem").select(F.col("l_suppkey").alias("party"))
    b = load(spark, sf, "orders").select(F.col("o_custkey").alias("party"))
    return a.unionByName(b).distinct()


_COPY = """(SELECT * EXCLUDE (o_custkey) REPLACE (CASE WHEN o_orderpriority = '5-LOW' THEN 0.0 ELSE o_totalprice END AS o_totalprice)
 FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH'))"""


@query(
    "reconcile_tables",
    f"""
WITH a AS (SELECT * EXCLUDE (o_custkey) FROM orders), b AS {_COPY}
SELECT 'orders' AS table_name, (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b,
  (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS n_union_distinct,
  (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS only_a,
  (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS only_b,
  (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) +
  (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS differing
UNION ALL
SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer),
  (SELECT count(*) FROM (SELECT DISTINCT * FROM customer)), 0, 0, 0""",
)
def reconcile_tables(spark, sf):
    """Orders against a copy with lost rows and changed prices; customers against themselves."""
    orders, customer = load(spark, sf, "orders"), load(spark, sf, "customer")
    price = F.when(F.col("o_orderpriority") == "5-LOW", 0.0).otherwise(F.col("o_totalprice"))
    copy = orders.where("not (o_orderstatus = 'P' and o_orderpriority = '2-HIGH')").withColumn("o_totalprice", price)
    pairs = {"orders": (orders, copy), "customer": (customer, customer)}
    return recon.compare_tables(pairs, exclude=["o_custkey"])
