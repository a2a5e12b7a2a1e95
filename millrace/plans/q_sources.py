"""Sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import csv_fields
from millrace.operators import cdc, cells, search, regions
from millrace.operators.ordered import with_previous
from millrace.plans import shared
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources import envelope, files, sqlscript
from millrace.sources.tables import load
from millrace.streaming.run import drain


@query("src_envelope", shared.ENVELOPE_SQL)
def src_envelope(spark, sf):
    """Messages pass through files and come back as a stream."""
    path = scratch_path(spark, "envelope")
    messages = shared.envelope(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    messages.write.parquet(path)
    rows = drain(envelope.read_envelope_files(spark, path), "src-envelope")
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("src_topic_value", f'SELECT topic, "value" FROM ({shared.ENVELOPE_SQL})')
def src_topic_value(spark, sf):
    raw = shared.envelope(spark, sf)
    raw = raw.withColumns({c: F.encode(c, "UTF-8") for c in ("key", "value")})
    return envelope.topic_values(envelope.decode(raw))


def _props_with_breaks(spark, sf):
    """Props of error events lose their closing brace."""
    broken = F.when(F.col("event_type") == "error", F.expr("substr(props, 1, length(props) - 1)"))
    return load(spark, sf, "events").select(
        "event_id", F.coalesce(broken, F.col("props")).alias("value")
    )


@query(
    "json_parse_drop_bad",
    f"SELECT event_id, {shared.K_SQL} AS k FROM events WHERE event_type <> 'error'",
)
def json_parse_drop_bad(spark, sf):
    good, _ = envelope.parse_json(_props_with_breaks(spark, sf), "value", "k bigint")
    return good


@query(
    "json_parse_rejects",
    "SELECT event_id, substr(props, 1, length(props) - 1) AS value FROM events WHERE event_type = 'error'",
)
def json_parse_rejects(spark, sf):
    _, bad = envelope.parse_json(_props_with_breaks(spark, sf), "value", "k bigint")
    return bad


@query("json_parse_strict", f"SELECT event_id, {shared.K_SQL} AS k FROM events")
def json_parse_strict(spark, sf):
    rows = load(spark, sf, "events").select("event_id", F.col("props").alias("value"))
    return envelope.parse_json_strict(rows, "value", "k bigint")


@query(
    "resume_from_offsets",
    f"""
WITH e AS ({shared.ENVELOPE_SQL}),
ledger AS (SELECT topic, "partition", max("offset") + 1 AS saved FROM e
           WHERE "timestamp" < TIMESTAMP '{shared.SPLIT_DAY} 00:00:00' AND topic <> 'view' GROUP BY ALL)
SELECT e.topic, e."partition", e."offset" FROM e LEFT JOIN ledger l
  ON l.topic = e.topic AND l."partition" = e."partition"
WHERE e."offset" >= coalesce(l.saved, 0)""",
)
def resume_from_offsets(spark, sf):
    messages = shared.envelope(spark, sf)
    read = messages.where((F.col("timestamp") < shared.SPLIT_DAY) & (F.col("topic") != "view"))
    ledger = envelope.next_offsets(read, "reader")
    return envelope.resume(messages, ledger, "reader").select("topic", "partition", "offset")


@query(
    "latest_partition_scan",
    """
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS dt FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
)
def latest_partition_scan(spark, sf):
    path = scratch_path(spark, "by-day")
    by_day = load(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("dt")
    )
    by_day.hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    rows = files.scan_latest_partition(spark, path, "dt")
    return rows.withColumn("dt", F.col("dt").cast("string"))


@query(
    "cdc_feed_decode",
    f"""
SELECT CASE WHEN event_type = 'error' THEN 'd' WHEN prev IS NULL THEN 'c' ELSE 'u' END AS op,
       CAST(user_id AS VARCHAR) AS "key", event_id AS seq, prev AS before_k,
       CASE WHEN event_type <> 'error' THEN k END AS after_k
FROM (SELECT *, lag(k) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
      FROM (SELECT *, {shared.K_SQL} AS k FROM events))""",
)
def cdc_feed_decode(spark, sf):
    rows = with_previous(shared.events_k(spark, sf), ["user_id"], ["ts", "event_id"], {"prev": "k"})
    deleted = F.col("event_type") == "error"
    op = F.when(deleted, "d").when(F.col("prev").isNull(), "c").otherwise("u")
    record = F.struct(
        op.alias("op"),
        F.col("user_id").cast("string").alias("key"),
        F.col("event_id").alias("seq"),
        F.when(F.col("prev").isNotNull(), F.struct(F.col("prev").alias("k"))).alias("before"),
        F.when(~deleted, F.struct("k")).alias("after"),
    )
    feed = rows.select(F.to_json(record).alias("value"))
    return cdc.decode_feed(feed, "value", "k: bigint").select(
        "op", "key", "seq", F.col("before.k").alias("before_k"), F.col("after.k").alias("after_k")
    )


_CHANGE = {"user_id": "bigint", "kind": "string", "day": "string"}


@query(
    "canal_parse",
    f"""WITH {shared.CANAL_CTE} SELECT op, id, user_id, kind, "day", "database", "table" FROM canal""",
)
def canal_parse(spark, sf):
    parsed = cdc.parse_canal(shared.canal_messages(spark, sf))
    rows = cdc.change_rows(parsed.withColumn("data", _tagged(parsed)), _CHANGE | {"db": "string", "tbl": "string"})
    return rows.select(
        "op", F.col("cdc_id").alias("id"), "user_id", "kind", "day", F.col("db").alias("database"), F.col("tbl").alias("table")
    )


def _tagged(parsed):
    """Each row also carries the names of its database and table."""
    names = F.create_map(F.lit("db"), F.col("database"), F.lit("tbl"), F.col("table"))
    return F.transform("data", lambda m: F.map_concat(m, names))


@query(
    "cdc_table_filter",
    f"""WITH {shared.CANAL_CTE} SELECT op, id, user_id, kind FROM canal WHERE "table" = 'user_state'""",
)
def cdc_table_filter(spark, sf):
    parsed = cdc.of_table(cdc.parse_canal(shared.canal_messages(spark, sf)), "shop", "user_state")
    return cdc.change_rows(parsed, _CHANGE).select("op", F.col("cdc_id").alias("id"), "user_id", "kind")


@query(
    "binlog_row_images",
    """
WITH ch AS (
  SELECT o_orderkey AS entry_id,
         CASE o_orderstatus WHEN 'F' THEN 'DELETE' WHEN 'O' THEN 'INSERT' ELSE 'UPDATE' END AS event_type,
         CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS price, o_orderpriority AS prio FROM orders)
SELECT entry_id, event_type, 'before' AS image, 'price' AS name, price AS value, false AS updated
  FROM ch WHERE event_type <> 'INSERT'
UNION ALL SELECT entry_id, event_type, 'before', 'priority', prio, false FROM ch WHERE event_type <> 'INSERT'
UNION ALL SELECT entry_id, event_type, 'after', 'price', price, event_type = 'INSERT' FROM ch WHERE event_type <> 'DELETE'
UNION ALL SELECT entry_id, event_type, 'after', 'priority', '1-URGENT', event_type = 'INSERT' OR prio <> '1-URGENT'
  FROM ch WHERE event_type <> 'DELETE'""",
)
def binlog_row_images(spark, sf):
    """Orders as row changes that raise the priority, between transaction marks."""
    orders = load(spark, sf, "orders")
    kind = (
        F.when(F.col("o_orderstatus") == "F", "DELETE")
        .when(F.col("o_orderstatus") == "O", "INSERT")
        .otherwise("UPDATE")
    )

    def image(priority):
        price = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
        return F.array(
            F.struct(F.lit("price").alias("name"), price.alias("value")),
            F.struct(F.lit("priority").alias("name"), priority.alias("value")),
        )

    rows = orders.select(
        F.col("o_orderkey").alias("entry_id"),
        F.lit("ROWDATA").alias("entry_type"),
        kind.alias("event_type"),
        F.when(kind != "INSERT", image(F.col("o_orderpriority"))).alias("before"),
        F.when(kind != "DELETE", image(F.lit("1-URGENT"))).alias("after"),
    )
    empty = F.lit(None).cast(rows.schema["before"].dataType)
    marks = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("entry_id"),
        F.lit("TRANSACTIONBEGIN").alias("entry_type"),
        F.lit(None).cast("string").alias("event_type"),
        empty.alias("before"),
        empty.alias("after"),
    )
    return cdc.row_images(rows.unionByName(marks))


@query("text_lines", r"""SELECT regexp_replace("text", '[\r\n]', ' ', 'g') AS value FROM documents""")
def text_lines(spark, sf):
    path = scratch_path(spark, "lines")
    one_line = F.regexp_replace("text", r"[\r\n]", " ")
    load(spark, sf, "documents").select(one_line.alias("value")).write.text(path)
    return files.text_lines(spark, path)


@query(
    "line_to_reading",
    """SELECT CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000 AS ts, value AS temperature, event_id AS seq FROM events""",
)
def line_to_reading(spark, sf):
    path = scratch_path(spark, "readings")
    line = F.concat_ws(
        ",", "user_id", F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), "value", "event_id"
    )
    load(spark, sf, "events").select(line.alias("value")).write.text(path)
    fields = {"id": "string", "ts": "bigint", "temperature": "double", "seq": "bigint"}
    stream = files.stream_lines(spark, path).select(*csv_fields(F.col("value"), fields))
    return drain(stream, "line-to-reading")


@query(
    "cell_range_scan",
    f"""
WITH {shared.CELLS_CTE}
SELECT row_key, string_agg(value, ',' ORDER BY qualifier) AS vals FROM latest
WHERE family = 'ord' AND row_key >= '0000000010' AND row_key < '0000000100' GROUP BY row_key""",
)
def cell_range_scan(spark, sf):
    return cells.range_scan(shared.cells(spark, sf), "0000000010", "0000000100", "ord")


@query(
    "region_range_scan",
    f"""
WITH {shared.CELLS_CTE}
SELECT row_key, string_agg(value, ',' ORDER BY qualifier) AS vals FROM latest
WHERE family = 'ord' AND row_key >= '0000000010' AND row_key < '0000000100' GROUP BY row_key""",
)
def region_range_scan(spark, sf):
    """The same scan over a table of sixteen regions; only those that overlap the range are opened."""
    table = regions.Regions(spark, scratch_path(spark, "regions"), "row_key").write(shared.cells(spark, sf))
    start, stop = "0000000010", "0000000100"
    return cells.range_scan(table.scan(start, stop), start, stop, "ord")


@query(
    "cell_full_scan",
    f"WITH {shared.CELLS_CTE} SELECT row_key, family, qualifier, value FROM latest",
)
def cell_full_scan(spark, sf):
    return cells.full_scan(shared.cells(spark, sf))


@query(
    "point_get",
    f"WITH {shared.CELLS_CTE} SELECT row_key, family, qualifier, value FROM latest WHERE row_key = '0000000042'",
)
def point_get(spark, sf):
    return cells.point_get(shared.cells(spark, sf), "0000000042")


@query(
    "multi_get",
    """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')""",
)
def multi_get(spark, sf):
    urgent = load(spark, sf, "orders").where("o_orderstatus = 'P' and o_orderpriority = '1-URGENT'")
    ids = urgent.select(F.col("o_custkey").alias("c_custkey"))
    return search.get_documents(load(spark, sf, "customer"), ids, "c_custkey").select(
        "c_custkey", "c_name"
    )


@query(
    "doc_match_all",
    """SELECT doc_id, lang, source, n_chars, (SELECT count(*) FROM documents) AS total_hits FROM documents""",
)
def doc_match_all(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return search.with_total(docs, docs)


def small_files(spark, sf) -> str:
    """Benchmark and conversation texts as JSON lines, in many small files."""
    path = scratch_path(spark, "small-files")
    rows = load(spark, sf, "conversations").select(F.to_json(F.struct("conv_id", "turn", "text")).alias("value"))
    rows.write.option("maxRecordsPerFile", 1000).text(path)
    return path


_CONVERSATIONS_SQL = 'SELECT conv_id, turn, "text" FROM conversations'


def _lines_back(packed):
    parsed = F.from_json("value", "conv_id bigint, turn bigint, text string").alias("j")
    return files.unpack_lines(packed).select(parsed).select("j.*")


@query("whole_file_read", _CONVERSATIONS_SQL)
def whole_file_read(spark, sf):
    whole = files.whole_files(spark, small_files(spark, sf), "*.txt")
    return _lines_back(whole.select("path", "content"))


@query("pack_small_files", _CONVERSATIONS_SQL)
def pack_small_files(spark, sf):
    target = scratch_path(spark, "packed")
    files.pack_small_files(spark, small_files(spark, sf), target, "*.txt")
    return _lines_back(spark.read.parquet(target))


_SCRIPT = """
-- daily report; the date comes from outside
create or replace temporary view day_orders as
select o_custkey, o_totalprice, 'a;b' as note from {orders}
where o_orderdate >= timestamp_ntz '${data_date} 00:00:00';
;
select n_name, note, count(*) as n, cast(round(sum(o_totalprice), 2) as decimal(20, 2)) as total
from day_orders join {customer} on c_custkey = o_custkey
join {nation} on n_nationkey = c_nationkey group by n_name, note
"""


@query(
    "sql_script_last_result",
    """
SELECT n_name, 'a;b' AS note, count(*) AS n, CAST(round(sum(o_totalprice), 2) AS DECIMAL(20, 2)) AS total
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' GROUP BY n_name""",
)
def sql_script_last_result(spark, sf):
    names = {t: f"script_{t}" for t in ("orders", "customer", "nation")}
    for table, view in names.items():
        load(spark, sf, table).createOrReplaceTempView(view)
    text = _SCRIPT.format(**names, data_date="{data_date}")
    return sqlscript.run_sql_script(spark, text, {"data_date": "1998-01-01"})[-1]
