"""Projections, filters, search predicates and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import csv_fields, words
from millrace.operators import inverted, cells, recon, routing, search
from millrace.plans import shared
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources.tables import load


@query("csv_map", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_acctbal AS amount, c_nationkey AS code FROM customer")
def csv_map(spark, sf):
    line = F.concat_ws(",", "c_custkey", "c_acctbal", "c_nationkey")
    lines = load(spark, sf, "customer").select(line.alias("line"))
    return lines.select(*csv_fields(F.col("line"), {"id": "string", "amount": "double", "code": "int"}))


@query(
    "words_flatmap",
    """SELECT conv_id, turn, unnest(string_split(regexp_replace("text", ' +$', ''), ' ')) AS word FROM conversations""",
)
def words_flatmap(spark, sf):
    return load(spark, sf, "conversations").select("conv_id", "turn", F.explode(words(F.col("text"))).alias("word"))


@query("filter_eq", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def filter_eq(spark, sf):
    return load(spark, sf, "events").where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@query("project_cols", "SELECT l_orderkey, l_quantity FROM lineitem")
def project_cols(spark, sf):
    return load(spark, sf, "lineitem").select("l_orderkey", "l_quantity")


@query("filter_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'blue%'")
def filter_prefix(spark, sf):
    return load(spark, sf, "part").where(F.col("p_name").startswith("blue")).select("p_partkey", "p_name")


@query(
    "route_threshold",
    """
SELECT event_id, CASE WHEN value < 30 THEN 'low' ELSE 'main' END AS route,
       CASE WHEN value > 30 THEN 'high' ELSE 'low' END AS route_high FROM events""",
)
def route_threshold(spark, sf):
    events = load(spark, sf, "events")
    tagged = routing.with_route(events, {"low": F.col("value") < 30}, "main")
    tagged = routing.with_route(tagged, {"high": F.col("value") > 30}, "low", "route_high")
    return tagged.select("event_id", "route", "route_high")


@query(
    "route_split_outputs",
    """
SELECT 'low' AS output, event_id, value FROM events WHERE value < 30
UNION ALL SELECT 'main', event_id, value FROM events WHERE value >= 30""",
)
def route_split_outputs(spark, sf):
    events = load(spark, sf, "events").select("event_id", "value")
    outputs = routing.split_by(events, {"low": F.col("value") < 30}, "main")
    named = [df.select(F.lit(name).alias("output"), "*") for name, df in outputs.items()]
    return named[0].unionByName(named[1])


@query(
    "route_two_level",
    """
SELECT c_custkey, r_name || '/' || c_mktsegment AS route FROM customer
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE (r_name = 'ASIA' AND c_mktsegment IN ('BUILDING', 'MACHINERY'))
   OR (r_name = 'EUROPE' AND c_mktsegment = 'FURNITURE')""",
)
def route_two_level(spark, sf):
    nation = load(spark, sf, "nation").join(
        load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = load(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    wanted = {"ASIA": ["BUILDING", "MACHINERY"], "EUROPE": ["FURNITURE"]}
    return routing.two_level_route(rows, "r_name", "c_mktsegment", wanted).select("c_custkey", "route")


@query("doc_term", "SELECT p_partkey, p_size FROM part WHERE p_size = 30")
def doc_term(spark, sf):
    return load(spark, sf, "part").where(search.term("p_size", 30)).select("p_partkey", "p_size")


_TOKENS = r"""list_filter(regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"""


@query(
    "doc_text_term",
    f"""SELECT doc_id FROM documents WHERE list_contains({_TOKENS.format(c='"text"')}, 'and')""",
)
def doc_text_term(spark, sf):
    return load(spark, sf, "documents").where(search.text_term("text", "and")).select("doc_id")


@query(
    "doc_match",
    f"""SELECT p_partkey, p_name FROM part WHERE list_has_any({_TOKENS.format(c="p_name")}, ['blue', 'gear'])""",
)
def doc_match(spark, sf):
    return load(spark, sf, "part").where(search.match("p_name", "Blue gear")).select("p_partkey", "p_name")


@query(
    "doc_match_text",
    f"""SELECT doc_id FROM documents WHERE list_has_any({_TOKENS.format(c='"text"')}, ['idiot', 'über', 'für'])""",
)
def doc_match_text(spark, sf):
    """Any of three words in whole documents of four languages."""
    return load(spark, sf, "documents").where(search.match("text", "Idiot ÜBER für")).select("doc_id")


@query(
    "doc_bool",
    """
SELECT p_partkey FROM part WHERE p_size >= 10 AND p_type <> 'SMALL'
  AND (p_brand = 'Brand#4' OR p_name LIKE '%ring%')""",
)
def doc_bool(spark, sf):
    wanted = search.bool_query(
        must=[search.in_range("p_size", gte=10)],
        must_not=[search.term("p_type", "SMALL")],
        should=[search.term("p_brand", "Brand#4"), F.col("p_name").contains("ring")],
        minimum_should=1,
    )
    return load(spark, sf, "part").where(wanted).select("p_partkey")


@query("doc_range", "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice >= 950 AND p_retailprice < 1000")
def doc_range(spark, sf):
    rows = load(spark, sf, "part").where(search.in_range("p_retailprice", 950.0, 1000.0))
    return rows.select("p_partkey", "p_retailprice")


@query(
    "doc_fuzzy",
    f"""
SELECT p_partkey, p_name FROM part
WHERE len(list_filter({_TOKENS.format(c="p_name")}, lambda t: levenshtein(t, 'bear') <= 2)) > 0""",
)
def doc_fuzzy(spark, sf):
    return load(spark, sf, "part").where(search.fuzzy("p_name", "bear", 2)).select("p_partkey", "p_name")


@query(
    "doc_match_scored",
    f"""
WITH t AS (SELECT doc_id, unnest({_TOKENS.format(c='"text"')}) AS token FROM documents),
lengths AS (SELECT doc_id, count(*) AS length FROM t GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(length) / count(*) AS average FROM lengths),
postings AS (SELECT token, doc_id, count(*) AS freq FROM t WHERE token IN ('idiot', 'über', 'für', 'and') GROUP BY ALL),
df AS (SELECT token, count(*) AS n FROM postings GROUP BY token)
SELECT doc_id, round(sum(ln(1 + (docs - n + 0.5) / (n + 0.5)) * freq / (freq + 1.2 * (1 - 0.75 + 0.75 * length / average))), 6) AS score
FROM postings JOIN df USING (token) JOIN lengths USING (doc_id), totals GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 20""",
)
def doc_match_scored(spark, sf):
    """The best twenty documents for four words, from an index of all documents."""
    index = inverted.Index(spark, scratch_path(spark, "inverted"), "doc_id").build(load(spark, sf, "documents"), "text")
    return index.search("Idiot ÜBER für and", 20)


@query(
    "doc_fuzzy_transposed",
    f"""
SELECT p_partkey, p_name FROM part
WHERE len(list_filter({_TOKENS.format(c="p_name")}, lambda t: damerau_levenshtein(t, 'rnig') <= 1)) > 0""",
)
def doc_fuzzy_transposed(spark, sf):
    """Names with a word one edit away; a swap of neighbours is one."""
    part = load(spark, sf, "part").select("p_partkey", "p_name")
    index = inverted.Index(spark, scratch_path(spark, "inverted"), "p_partkey").build(part, "p_name", fuzzy=True)
    return part.join(index.documents_like("rnig", 1), "p_partkey", "left_semi")


@query("doc_source_filter", "SELECT p_partkey, p_brand FROM part")
def doc_source_filter(spark, sf):
    return search.source_filter(load(spark, sf, "part"), ["p_partkey", "p_name", "p_brand"], ["p_name"])


@query(
    "doc_highlight",
    r"""
SELECT p_partkey, p_name, regexp_replace(p_name, '\b(ring)\b', '<em>\1</em>', 'gi') AS highlighted
FROM part WHERE regexp_matches(p_name, '\bring\b', 'i')""",
)
def doc_highlight(spark, sf):
    hits = load(spark, sf, "part").where(search.match("p_name", "ring"))
    return hits.select("p_partkey", "p_name", search.highlight("p_name", "ring").alias("highlighted"))


@query(
    "rowkey_regex",
    f"WITH {shared.CELLS_CTE} SELECT row_key, family, qualifier, value FROM latest WHERE row_key LIKE '%7'",
)
def rowkey_regex(spark, sf):
    return cells.full_scan(shared.cells(spark, sf).where(cells.row_key_matches("7$")))


@query(
    "cell_value_filter",
    f"""
WITH {shared.CELLS_CTE} SELECT row_key, family, qualifier, value FROM latest
WHERE row_key NOT IN (SELECT row_key FROM latest WHERE family = 'ord' AND qualifier = 'status' AND value <> 'F')""",
)
def cell_value_filter(spark, sf):
    return cells.value_filter(shared.cells(spark, sf), "ord", "status", "F")


@query(
    "cell_value_filter_strict",
    f"""
WITH {shared.CELLS_CTE} SELECT row_key, family, qualifier, value FROM latest
WHERE row_key IN (SELECT row_key FROM latest WHERE family = 'ord' AND qualifier = 'status' AND value = 'F')""",
)
def cell_value_filter_strict(spark, sf):
    return cells.value_filter(shared.cells(spark, sf), "ord", "status", "F", filter_if_missing=True)


@query(
    "cell_prefix_filter",
    f"WITH {shared.CELLS_CTE} SELECT row_key, family, qualifier, value FROM latest WHERE qualifier LIKE 's%'",
)
def cell_prefix_filter(spark, sf):
    return cells.full_scan(cells.prefix_filter(shared.cells(spark, sf), "s"))


@query(
    "cell_filter_all",
    f"""
WITH {shared.CELLS_CTE} SELECT row_key, family, qualifier, value FROM latest
WHERE qualifier LIKE 's%'
  AND row_key NOT IN (SELECT row_key FROM latest WHERE family = 'ord' AND qualifier = 'status' AND value <> 'F')""",
)
def cell_filter_all(spark, sf):
    return cells.all_filters(shared.cells(spark, sf), "ord", "status", "F", "s")


@query("cols_except_regex", "SELECT * EXCLUDE (o_custkey, o_orderdate) FROM orders")
def cols_except_regex(spark, sf):
    return recon.columns_except(load(spark, sf, "orders"), ["o_custkey", "o_orderdate"])
