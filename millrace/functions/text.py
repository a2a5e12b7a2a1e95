"""Words, JSON and map helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(c: Column) -> Column:
    """Split on single spaces; empty words at the end are dropped, as in the usual JVM split."""
    return F.split(F.regexp_replace(c, " +$", ""), " ")


def tokens(c: Column) -> Column:
    """Lower-case runs of letters and digits; each ideograph or kana is a token of its own."""
    apart = F.regexp_replace(F.lower(c), r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}])", " $1 ")
    return F.filter(F.split(apart, r"[^\p{L}\p{N}]+"), lambda t: t != "")


def computed_once(df: DataFrame, expr: Column, name: str) -> DataFrame:
    """df plus one column whose expression is evaluated once per row.

    A generator stands between the expression and later filters, which the optimizer would else
    push below the projection and so evaluate costly parsing again in each condition.
    """
    return df.select("*", F.explode_outer(F.array(expr)).alias(name))


def lower_keys(m: Column) -> Column:
    """Keys in lower case; of keys that fall together the last entry wins."""
    names = F.transform(F.map_keys(m), lambda k: F.lower(k))
    apart = F.size(F.array_distinct(names)) == F.size(m)
    return F.when(apart, F.transform_keys(m, lambda k, v: F.lower(k))).otherwise(_last_of_each(m))


def _last_of_each(m: Column) -> Column:
    entries = F.map_entries(m)
    lowered = F.transform(
        entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    names = F.transform(lowered, lambda e: e["key"])
    kept = F.filter(
        lowered,
        lambda e, i: F.array_position(F.slice(names, i + 2, F.size(names)), e["key"]) == 0,
    )
    return F.map_from_entries(kept)


def csv_fields(line: Column, names_and_types: dict[str, str], sep: str = ",") -> list[Column]:
    """One column per field of a delimited line; text that does not cast becomes null."""
    parts = F.split(line, sep)
    return [
        F.try_element_at(parts, F.lit(i + 1)).try_cast(kind).alias(name)
        for i, (name, kind) in enumerate(names_and_types.items())
    ]
