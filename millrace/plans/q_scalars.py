"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates, rowkeys, status
from millrace.functions.text import lower_keys
from millrace.operators import cdc
from millrace.plans import shared
from millrace.plans.registry import query
from millrace.sources.tables import load

_CHAR_SQL = f"SELECT unnest(string_split({shared.STATUS_SQL}, '')) AS ch FROM lineitem"


def _chars(spark, sf):
    """Every character of every status text."""
    chars = F.split(shared.status_text(), "")
    return load(spark, sf, "lineitem").select(F.explode(chars).alias("ch"))


@query(
    "fn_status_rank",
    f"SELECT ch, instr('{status.SEVERITY}', ch) AS severity, count(*) AS n FROM ({_CHAR_SQL}) GROUP BY ALL",
)
def fn_status_rank(spark, sf):
    severity = status.status_rank(F.col("ch")).cast("long").alias("severity")
    return _chars(spark, sf).groupBy("ch", severity).agg(shared.n_rows())


@query(
    "fn_status_grade",
    f"""SELECT ch, CASE WHEN ch IN ('B','Z','D','G') THEN '8' WHEN ch BETWEEN '1' AND '7' THEN ch
  WHEN ch IN ('0','A','N','M') THEN '0' WHEN ch IN ('*','C','#','/') THEN '.' END AS grade, count(*) AS n
FROM ({_CHAR_SQL}) GROUP BY ALL""",
)
def fn_status_grade(spark, sf):
    return _chars(spark, sf).groupBy("ch", status.status_grade(F.col("ch")).alias("grade")).agg(shared.n_rows())


_TEXT_SQL = """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '-' || o_orderkey WHEN '2-HIGH' THEN '+'
  WHEN '3-MEDIUM' THEN '' WHEN '5-LOW' THEN CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS txt FROM orders"""


@query("fn_is_integer", f"SELECT *, regexp_full_match(txt, '[-+]?[0-9]*') AS ok FROM ({_TEXT_SQL})")
def fn_is_integer(spark, sf):
    p = F.col("o_orderpriority")
    txt = (
        F.when(p == "1-URGENT", F.concat(F.lit("-"), F.col("o_orderkey").cast("string")))
        .when(p == "2-HIGH", "+")
        .when(p == "3-MEDIUM", "")
        .when(p == "5-LOW", F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    rows = load(spark, sf, "orders").select("o_orderkey", txt.alias("txt"))
    return rows.withColumn("ok", status.is_integer_text(F.col("txt")))


@query(
    "fn_date_valid",
    """
SELECT o_orderkey, txt, try_strptime(substr(trim(txt), 1, 10), '%Y-%m-%d') IS NOT NULL AS is_date,
       try_strptime(substr(trim(txt), 1, 19), '%Y-%m-%d %H:%M:%S') IS NOT NULL AS is_datetime
FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, ' %Y-%m-%d')
  WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ':023'
  WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m') || '-31' WHEN '5-LOW' THEN o_orderstatus
  ELSE strftime(o_orderdate, '%Y/%m/%d') END AS txt FROM orders)""",
)
def fn_date_valid(spark, sf):
    """The 31st does not exist in every month; those texts are no dates."""
    p, d = F.col("o_orderpriority"), F.col("o_orderdate")
    txt = (
        F.when(p == "1-URGENT", F.concat(F.lit(" "), F.date_format(d, "yyyy-MM-dd")))
        .when(p == "2-HIGH", F.concat(F.date_format(d, "yyyy-MM-dd HH:mm:ss"), F.lit(":023")))
        .when(p == "3-MEDIUM", F.concat(F.date_format(d, "yyyy-MM"), F.lit("-31")))
        .when(p == "5-LOW", F.col("o_orderstatus"))
        .otherwise(F.date_format(d, "yyyy/MM/dd"))
    )
    rows = load(spark, sf, "orders").select("o_orderkey", txt.alias("txt"))
    return rows.withColumns(
        {
            "is_date": dates.is_valid_date(F.col("txt")),
            "is_datetime": dates.is_valid_datetime(F.col("txt")),
        }
    )


@query(
    "fn_date_format",
    """SELECT event_id, strftime(ts, '%Y/%m/%d') AS slashed, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS txt FROM events""",
)
def fn_date_format(spark, sf):
    day = F.date_format("ts", "yyyy-MM-dd")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return load(spark, sf, "events").select(
        "event_id",
        dates.reformat_date(day, "yyyy/MM/dd").alias("slashed"),
        dates.millis_to_text(millis).alias("txt"),
    )


@query(
    "fn_local_to_epoch",
    "SELECT event_id, epoch_ms(date_trunc('second', ts) - INTERVAL 8 HOUR) AS millis FROM events",
)
def fn_local_to_epoch(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return load(spark, sf, "events").select("event_id", dates.local_text_to_millis(text).alias("millis"))


@query(
    "fn_map_lower_keys",
    """SELECT c_custkey, c_mktsegment AS name, CAST(c_nationkey AS VARCHAR) AS nation, 2 AS n_keys FROM customer""",
)
def fn_map_lower_keys(spark, sf):
    """NAME and name fall together; the later entry stays."""
    m = F.create_map(
        F.lit("NAME"), F.col("c_name"), F.lit("Nation"), F.col("c_nationkey").cast("string"),
        F.lit("name"), F.col("c_mktsegment"),
    )
    rows = load(spark, sf, "customer").select("c_custkey", lower_keys(m).alias("m"))
    return rows.select("c_custkey", F.col("m.name").alias("name"), F.col("m.nation").alias("nation"), F.size("m").alias("n_keys"))


@query(
    "fn_rows_to_json",
    f"""WITH {shared.CANAL_CTE}
SELECT id, '{{"user_id":"' || user_id || '","kind":"' || kind || '","day":"' || "day" || '"}}' AS json FROM canal""",
)
def fn_rows_to_json(spark, sf):
    parsed = cdc.parse_canal(shared.canal_messages(spark, sf))
    return cdc.rows_to_json(parsed).select(F.col("cdc_id").alias("id"), "json")


_HASH_SQL = """list_reduce(list_transform(range(1, length(c_name) + 1), lambda i: CAST(ascii(substr(c_name, i, 1)) AS BIGINT)),
  lambda a, b: (a * 31 + b) % 4294967296)"""
_ROWKEY_SQL = f"""SELECT c_custkey, lpad(CAST(({_HASH_SQL} & 2147483647) % 8 AS VARCHAR), 4, '0') || substr(md5(c_name), 1, 12) AS row_key
FROM customer"""


@query("fn_salted_rowkey", _ROWKEY_SQL)
def fn_salted_rowkey(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", rowkeys.salted_row_key(F.col("c_name"), 8).alias("row_key"))


@query("rowkey_prefix_balance", f"SELECT substr(row_key, 1, 4) AS prefix, count(*) AS n FROM ({_ROWKEY_SQL}) GROUP BY 1")
def rowkey_prefix_balance(spark, sf):
    return rowkeys.prefix_balance(fn_salted_rowkey(spark, sf), "row_key")


@query("fn_month_of_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS month FROM orders")
def fn_month_of_date(spark, sf):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return load(spark, sf, "orders").select("o_orderkey", dates.month_of(day).alias("month"))


@query(
    "fn_window_start",
    """SELECT event_id, time_bucket(INTERVAL '15 seconds', ts) AS w15,
  time_bucket(INTERVAL '15 seconds', ts - INTERVAL 5 SECOND) + INTERVAL 5 SECOND AS shifted FROM events""",
)
def fn_window_start(spark, sf):
    events = load(spark, sf, "events")
    plain = events.select("event_id", "ts", dates.window_start(F.col("ts"), "15 seconds").alias("w15"))
    return plain.select(
        "event_id", "w15", dates.window_start(F.col("ts"), "15 seconds", "5 seconds").alias("shifted")
    )
