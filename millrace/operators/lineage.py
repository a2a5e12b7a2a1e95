"""Table lineage over a table of SQL texts, by regular expressions in Spark columns.

Statements are cut, comments and literals blanked. Bracketed groups are folded from the innermost
outwards: a group that is a query or a join gives its own sources, any other (a call, a column list)
gives none. What is left at each level is flat, and table names are taken after FROM, JOIN, INSERT
and CREATE TABLE. Names of common table expressions, in any case, are removed from the inputs. This
covers the usual warehouse scripts, not every construct of a SQL dialect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.functions.text import computed_once
from millrace.session import cut_lineage, scratch_path

_NAME = r"[A-Za-z_][A-Za-z0-9_]*(?:\.[A-Za-z_][A-Za-z0-9_]*)*"
_NOISE = r"""(?s)--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""
_SOURCES = (
    rf"(?i)\b(?:from|join)\s+((?:{_NAME}(?:\s+(?:as\s+)?[A-Za-z_][A-Za-z0-9_]*)?\s*,\s*)*{_NAME})"
)
_TARGETS = (
    r"(?i)\b(?:insert\s+(?:overwrite|into)\s+(?:table\s+)?"
    r"|create\s+(?:or\s+replace\s+)?(?:external\s+|temporary\s+)?table\s+(?:if\s+not\s+exists\s+)?)"
    rf"({_NAME})"
)
_FOLDED = "__folded__"
_CTES = rf"(?i)(?:\bwith|,)\s*({_NAME})\s+as\s*\("


def statements(scripts: DataFrame) -> DataFrame:
    """(script_id, sql) to (script_id, statement_no, statement) without comments and literals."""
    clean = F.replace(F.regexp_replace("sql", _NOISE, " "), F.lit("`"), F.lit(""))
    # the outer form does not test the array's size first, which would clean all texts twice
    cut = scripts.select("script_id", F.posexplode_outer(F.split(clean, ";")).alias("pos", "statement"))
    return cut.where(F.col("statement").rlike(r"\S")).select(
        "script_id", F.col("pos").cast("long").alias("statement_no"), "statement"
    )


def _flat_sources(text: Column) -> Column:
    lists = F.regexp_extract_all(text, F.lit(_SOURCES), F.lit(1))
    items = F.flatten(F.transform(lists, lambda s: F.split(s, r"\s*,\s*")))
    return F.transform(items, lambda s: F.element_at(F.split(s, r"\s"), 1))


def _folded(text: Column) -> Column:
    """(text, found): brackets folded, and the sources of what stood in them.

    Each round folds all innermost groups, until no bracket is left.
    """

    def fold(state: Column, _: Column) -> Column:
        groups = F.regexp_extract_all(state["text"], F.lit(r"\(([^()]*)\)"), F.lit(1))
        queries = F.filter(groups, lambda g: g.rlike(r"(?i)\b(?:select|join)\b"))
        own = F.flatten(
            F.transform(queries, lambda g: _flat_sources(F.when(g.rlike(r"(?i)\bselect\b"), g).otherwise(F.concat(F.lit("from "), g))))
        )
        folded = F.struct(
            F.regexp_replace(state["text"], r"\([^()]*\)", f" {_FOLDED} ").alias("text"),
            F.concat(state["found"], own).alias("found"),
        )
        return F.when(state["text"].contains("("), folded).otherwise(state)

    start = F.struct(text.alias("text"), F.array().cast("array<string>").alias("found"))
    brackets = F.length(text) - F.length(F.replace(text, F.lit("("), F.lit("")))
    rounds = F.slice(F.sequence(F.lit(0), brackets), F.lit(1), brackets)
    return F.aggregate(rounds, start, fold)


def table_names(scripts: DataFrame) -> DataFrame:
    """Per statement the arrays inputs, outputs and ctes."""
    text = F.col("statement")
    ctes = F.when(
        text.rlike(r"(?i)\bwith\s"), F.array_distinct(F.regexp_extract_all(text, F.lit(_CTES), F.lit(1)))
    ).otherwise(F.array().cast("array<string>"))
    folded = computed_once(statements(scripts), _folded(text), "__state")
    state = F.col("__state")
    sources = F.concat(state["found"], _flat_sources(state["text"]))
    named = F.array_distinct(F.filter(sources, lambda n: n != _FOLDED))
    found = computed_once(folded, named, "all_inputs").select(
        "script_id",
        "statement_no",
        "all_inputs",
        F.array_distinct(F.regexp_extract_all(text, F.lit(_TARGETS), F.lit(1))).alias("outputs"),
        ctes.alias("ctes"),
    )
    return found.select(
        "script_id",
        "statement_no",
        F.filter(
            "all_inputs", lambda n: ~F.array_contains(F.transform("ctes", lambda c: F.lower(c)), F.lower(n))
        ).alias("inputs"),
        "outputs",
        "ctes",
    )


def edges(scripts: DataFrame) -> DataFrame:
    """(script_id, statement_no, input_table, output_table)."""
    names = table_names(scripts)
    for column, name in (("inputs", "input_table"), ("outputs", "output_table")):
        # the outer form does not test the array's size first, which would match all texts twice
        names = names.withColumn(name, F.explode_outer(column)).where(F.col(name).isNotNull())
    return names.select("script_id", "statement_no", "input_table", "output_table")


def downstream(edge_table: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, table_name, depth): tables fed by each root, with the least number of steps.

    Breadth first: only the frontier is joined in each round. Rounds are cut by written
    tables, and names already reached are dropped, so cycles end and every chain is followed to its end.
    """
    steps = cut_lineage(
        edge_table.select(
            F.col("input_table").alias("__from"), F.col("output_table").alias("table_name")
        ).distinct()
    )
    spark = edge_table.sparkSession
    path = scratch_path(spark, "reach")
    frontier = roots.select(F.col("table_name").alias("root"), "table_name").distinct()
    kind = StructType(list(frontier.schema.fields))
    depth = 0
    while True:  # one folder per depth; they are read together as one table
        frontier.write.parquet(f"{path}/depth={depth}")
        frontier = spark.read.schema(kind).parquet(f"{path}/depth={depth}")
        seen = spark.read.schema(StructType([*kind.fields, StructField("depth", LongType())])).parquet(path)
        if depth and frontier.isEmpty():
            return seen.where(F.col("depth") > 0)
        depth += 1
        frontier = (
            frontier.withColumnRenamed("table_name", "__from")
            .join(steps, "__from")
            .select("root", "table_name")
            .distinct()
            .join(seen.select("root", "table_name"), ["root", "table_name"], "left_anti")
        )


def upstream(edge_table: DataFrame, roots: DataFrame) -> DataFrame:
    turned = edge_table.select(
        F.col("output_table").alias("input_table"), F.col("input_table").alias("output_table")
    )
    return downstream(turned, roots)
