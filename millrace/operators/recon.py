"""Comparing two tables row by row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare(name: str, a: DataFrame, b: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """One row: row counts, distinct rows of the union, and rows found on one side only.

    ``differing`` counts the rows, repeats included, that have no counterpart on the other side: the
    tables hold the same rows if and only if it is 0. Columns are matched by name without the excluded
    ones, and must be the same on both sides; equal rows meet in one map-side combined aggregate.
    """
    columns = [c for c in a.columns if c not in exclude]
    if sorted(columns) != sorted(c for c in b.columns if c not in exclude):
        raise ValueError(f"{name}: the tables have unlike columns")
    both = (
        a.select(*columns, F.lit(1).cast("long").alias("__a"), F.lit(0).cast("long").alias("__b"))
        .unionByName(
            b.select(*columns, F.lit(0).cast("long").alias("__a"), F.lit(1).cast("long").alias("__b"))
        )
        .groupBy(*columns)
        .agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    )
    zero = F.lit(0).cast("long")
    return both.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("__a"), zero).alias("n_a"),
        F.coalesce(F.sum("__b"), zero).alias("n_b"),
        F.count(F.lit(1)).alias("n_union_distinct"),
        F.count_if(F.col("__b") == 0).alias("only_a"),
        F.count_if(F.col("__a") == 0).alias("only_b"),
        F.coalesce(F.sum(F.abs(F.col("__a") - F.col("__b"))), zero).alias("differing"),
    )


def compare_tables(
    pairs: dict[str, tuple[DataFrame, DataFrame]], exclude: list[str] = ()
) -> DataFrame:
    """The comparison of each named pair, one row per table."""
    rows = [compare(name, a, b, exclude) for name, (a, b) in pairs.items()]
    return reduce(DataFrame.unionByName, rows)


def columns_except(df: DataFrame, names: list[str]) -> DataFrame:
    """All columns but the named ones, chosen by a column regex."""
    return df.select(df.colRegex(f"`({'|'.join(names)})?+.+`"))
