"""Broadcast, lookup, dictionary and as-of joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only where the planner's size estimate, an upper bound here, is small.

    Nothing is run to find out. Anything else stays without a hint, and the join is shuffled with skew
    splitting unless the sizes that AQE sees at run time allow a broadcast.
    """
    if df.isStreaming or _estimated_bytes(df) > max_bytes:
        return df
    return F.broadcast(df)


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last in order; max_by combines map-side, so hot keys do not gather."""
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"__row.{c}") for c in rest])


def broadcast_left(fact: DataFrame, dim: DataFrame, on: list[str], order: list[str]) -> DataFrame:
    """Map-side left join: every fact row once, null where the small side has no such key.

    ``order`` names the columns that decide which of several small-side rows is the last.
    """
    return fact.join(broadcast_if_small(last_per_key(dim, on, order)), on, "left")


def inner_shuffled(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Plain equi join; AQE picks the strategy and splits skewed partitions."""
    return left.join(right, on, "inner")


def lookup(
    stream: DataFrame,
    dim: DataFrame,
    on: list[str],
    columns: list[str],
    how: str = "inner",
    order: list[str] | None = None,
) -> DataFrame:
    """Enrich rows from a dimension. inner drops misses, left keeps them with nulls.

    Without ``order`` a key may match several dimension rows (0..n results); with it the last wins.
    """
    side = dim.select(*dict.fromkeys([*on, *columns, *(order or [])]))
    if order:
        side = last_per_key(side, on, order)
    side = side.select(*on, *[c for c in columns if c not in on])
    # a hint in a stream would hold for its life, though the dimension may grow
    return stream.join(side if stream.isStreaming else broadcast_if_small(side), on, how)


def asof_join(
    left: DataFrame,
    versions: DataFrame,
    on: list[str],
    left_time: str,
    valid_from: str,
    columns: dict[str, str],
    tie: list[str],
    how: str = "inner",
    hot_rows: int | None = None,
) -> DataFrame:
    """For each left row the newest version of its key with ``valid_from <= left_time``.

    Both sides are stacked and scanned once in time order, carrying the last version seen.
    ``columns`` maps new names to version columns; ``tie`` orders versions of equal time.
    """
    from millrace.operators.ordered import HOT_ROWS, Running, running

    nulls = [F.lit(None).cast(versions.schema[c].dataType).alias(f"__tie{i}") for i, c in enumerate(tie)]
    picked = F.struct(*[F.col(c).alias(new) for new, c in columns.items()])
    l_side = left.select(
        F.struct("*").alias("__l"),
        *[F.col(k).alias(f"__k_{k}") for k in on],
        F.col(left_time).alias("__t"),
        F.lit(1).alias("__side"),
        *nulls,
    )
    r_side = versions.where(_all_not_null([*on, valid_from])).select(
        *[F.col(k).alias(f"__k_{k}") for k in on],
        F.col(valid_from).alias("__t"),
        F.lit(0).alias("__side"),
        *[F.col(c).alias(f"__tie{i}") for i, c in enumerate(tie)],
        picked.alias("__r"),
    )
    both = l_side.unionByName(r_side, allowMissingColumns=True)
    order = ["__t", "__side", *[f"__tie{i}" for i in range(len(tie))]]
    scanned = running(
        both,
        [f"__k_{k}" for k in on],
        order,
        {"__ver": Running("last", F.col("__r"))},
        hot_rows or HOT_ROWS,
    ).where(F.col("__side") == 1)
    if how == "inner":
        scanned = scanned.where(F.col("__ver").isNotNull())
    return scanned.select("__l.*", *[F.col(f"__ver.{new}").alias(new) for new in columns])


def _all_not_null(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])


def code_dictionary(entries: DataFrame, order: list[str] | None = None) -> DataFrame:
    """(family, code, label) with one label per family and code."""
    return last_per_key(entries, ["family", "code"], order or ["label"]).select(
        "family", "code", "label"
    )


def decode_codes(
    df: DataFrame, dictionary: DataFrame, families: dict[str, str], suffix: str = "_label"
) -> DataFrame:
    """Add ``<column><suffix>`` for each column, whose codes belong to the given family."""
    return _translate(df, dictionary, families, "code", "label", suffix)


def encode_labels(
    df: DataFrame, dictionary: DataFrame, families: dict[str, str], suffix: str = "_code"
) -> DataFrame:
    """The reverse: label to code; the greatest code wins where a label has several."""
    reverse = dictionary.groupBy("family", "label").agg(F.max("code").alias("code"))
    return _translate(df, reverse, families, "label", "code", suffix)


def _translate(
    df: DataFrame, dictionary: DataFrame, families: dict[str, str], key: str, value: str, suffix: str
) -> DataFrame:
    out = df
    for column, family in families.items():
        entries = dictionary.where(F.col("family") == family).select(
            F.col(key).alias(f"__k_{column}"), F.col(value).alias(f"{column}{suffix}")
        )
        same = F.col(column).cast("string") == F.col(f"__k_{column}")
        out = out.join(broadcast_if_small(entries), same, "left").drop(f"__k_{column}")
    return out
