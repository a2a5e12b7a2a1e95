"""Lineage over SQL texts that are built from the tables, one script per row."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import lineage, scopes
from millrace.plans.registry import query
from millrace.sources.tables import load


def _text(template: str, *columns: str):
    return F.format_string(template, *[F.col(c) for c in columns])


def scripts(spark, sf):
    """Three layers: regions feed nations, nations feed customers, customers feed orders."""
    nation = load(spark, sf, "nation").select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("script_id"),
        _text(
            "-- from nowhere\ncreate table if not exists ods.nation_%d as select * from raw.region_%d r;",
            "n_nationkey", "n_regionkey",
        ).alias("sql"),
    )
    customer = load(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("script_id"),
        _text(
            "set x = 'a;b';\nwith base as (select * from `ods`.nation_%d where note = 'join lost; x')\n"
            "insert overwrite table dw.cust_%d partition (dt='1') select b.* from base b /* join dead */ join ods.seg s on s.k = b.k",
            "c_nationkey", "c_custkey",
        ).alias("sql"),
    )
    orders = load(spark, sf, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("script_id"),
        _text(
            "INSERT INTO mart.order_%d SELECT a.x FROM dw.cust_%d a, dw.calendar c WHERE a.d = c.d",
            "o_orderkey", "o_custkey",
        ).alias("sql"),
    )
    return nation.unionByName(customer).unionByName(orders)


@query(
    "sql_lineage_edges",
    """
SELECT 'n' || n_nationkey AS script_id, 0 AS statement_no, 'raw.region_' || n_regionkey AS input_table, 'ods.nation_' || n_nationkey AS output_table FROM nation
UNION ALL SELECT 'c' || c_custkey, 1, 'ods.nation_' || c_nationkey, 'dw.cust_' || c_custkey FROM customer
UNION ALL SELECT 'c' || c_custkey, 1, 'ods.seg', 'dw.cust_' || c_custkey FROM customer
UNION ALL SELECT 'o' || o_orderkey, 0, 'dw.cust_' || o_custkey, 'mart.order_' || o_orderkey FROM orders
UNION ALL SELECT 'o' || o_orderkey, 0, 'dw.calendar', 'mart.order_' || o_orderkey FROM orders""",
)
def sql_lineage_edges(spark, sf):
    return lineage.edges(scripts(spark, sf))


@query(
    "sql_lineage_closure",
    """
SELECT 'raw.region_' || n_regionkey AS root, 'ods.nation_' || n_nationkey AS table_name, 1 AS depth FROM nation
UNION ALL SELECT 'raw.region_' || n_regionkey, 'dw.cust_' || c_custkey, 2 FROM customer JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT 'raw.region_' || n_regionkey, 'mart.order_' || o_orderkey, 3
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
)
def sql_lineage_closure(spark, sf):
    """Everything fed by the raw region tables."""
    roots = load(spark, sf, "region").select(
        F.concat(F.lit("raw.region_"), F.col("r_regionkey").cast("string")).alias("table_name")
    )
    return lineage.downstream(lineage.edges(scripts(spark, sf)), roots)


def scoped_scripts(spark, sf):
    """Names that are hidden in a part of a statement only, calls with FROM, and two inserts of one FROM."""
    nation = load(spark, sf, "nation").select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("script_id"),
        _text(
            "insert into ods.nation_%d select * from (with seg as (select * from raw.region_%d) select * from seg) x\n"
            "join SEG y on x.k = y.k where x.a is distinct from y.a",
            "n_nationkey", "n_regionkey",
        ).alias("sql"),
    )
    customer = load(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("script_id"),
        _text(
            "with t as (select * from t, ods.nation_%d), u as (select trim(both 'x' from t.a) a from t)\n"
            "insert overwrite table dw.cust_%d select u.a from U join (ods.x join ods.y on x.k = y.k) on u.k = x.k",
            "c_nationkey", "c_custkey",
        ).alias("sql"),
    )
    orders = load(spark, sf, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("script_id"),
        _text(
            "set a = 1; from dw.cust_%d c join dw.calendar d on c.d = d.d\n"
            "insert overwrite table mart.day_%d partition (dt='1') select extract(year from d.d) where c.k in (select k from ods.keys)\n"
            "insert into mart.all select c.*",
            "o_custkey", "o_orderkey",
        ).alias("sql"),
    )
    return nation.unionByName(customer).unionByName(orders)


@query(
    "sql_lineage_scopes",
    """
WITH n AS (SELECT 'n' || n_nationkey AS script_id, 'raw.region_' || n_regionkey AS region, 'ods.nation_' || n_nationkey AS target FROM nation),
c AS (SELECT 'c' || c_custkey AS script_id, 'ods.nation_' || c_nationkey AS nation, 'dw.cust_' || c_custkey AS target FROM customer),
o AS (SELECT 'o' || o_orderkey AS script_id, 'dw.cust_' || o_custkey AS cust, 'mart.day_' || o_orderkey AS target FROM orders)
SELECT script_id, 0 AS statement_no, input_table, target AS output_table
FROM (SELECT script_id, target, unnest([region, 'SEG']) AS input_table FROM n
  UNION ALL SELECT script_id, target, unnest([nation, 't', 'ods.x', 'ods.y']) FROM c)
UNION ALL SELECT script_id, 1, unnest([cust, 'dw.calendar', 'ods.keys']), target FROM o
UNION ALL SELECT script_id, 1, unnest([cust, 'dw.calendar']), 'mart.all' FROM o""",
)
def sql_lineage_scopes(spark, sf):
    return scopes.scoped_edges(scoped_scripts(spark, sf))
