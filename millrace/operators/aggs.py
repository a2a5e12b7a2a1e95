"""Grouped, windowed and skew-aware aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import words
from millrace.operators.ordered import (
    HOT_ROWS,
    Running,
    between_scans,
    probe_hot_keys,
    row_numbers,
    running,
    with_previous,
)


def tumbling(df: DataFrame, ts: str, size: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregates per [start, start + size) window and key; partial results combine map-side."""
    grouped = df.groupBy(F.window(ts, size).alias("__w"), *keys).agg(*aggs)
    return _window_columns(grouped)


def sliding(
    df: DataFrame, ts: str, size: str, slide: str, keys: list[str], aggs: list[Column]
) -> DataFrame:
    grouped = df.groupBy(F.window(ts, size, slide).alias("__w"), *keys).agg(*aggs)
    return _window_columns(grouped)


def _window_columns(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "__w"]
    return df.select(
        F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *rest
    )


def first_min_row(value: str, order: list[str], columns: list[str]) -> Column:
    """Aggregate: the whole row that holds the minimum; the first in order wins ties."""
    return F.min_by(F.struct(*columns), F.struct(value, *order))


def window_distinct(df: DataFrame, ts: str, size: str, keys: list[str], value: str) -> DataFrame:
    """Exact distinct values per window, in two combinable steps (no set per window in memory)."""
    return tumbling(df, ts, size, keys, [F.count_distinct(F.col(value)).alias("n_distinct")])


def window_bitmap_distinct(df: DataFrame, ts: str, size: str, ident: str) -> DataFrame:
    """Exact distinct non-negative integer ids per window by bitmaps of 32768 bits each."""
    parts = df.groupBy(
        F.window(ts, size).alias("__w"), F.bitmap_bucket_number(F.col(ident)).alias("__b")
    ).agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(ident)))).alias("__c"))
    return _window_columns(parts.groupBy("__w").agg(F.sum("__c").alias("n_distinct")))


#: A sketch of 2**12 registers; its estimates have a standard error of about 1.04 / 2**6.
SKETCH_BITS = 12


def sketch_error(bits: int = SKETCH_BITS) -> float:
    return 1.04 / 2 ** (bits / 2)


def sliding_sketch_distinct(
    df: DataFrame, ts: str, size: str, slide: str, keys: list[str], value: str, bits: int = SKETCH_BITS
) -> DataFrame:
    """About how many distinct values each sliding window has, of any type.

    A row enters one sketch only, that of its pane of ``slide``; the panes' sketches, a few kilobytes each, are
    merged into the windows. ``size`` must be a multiple of ``slide``.
    """
    panes = df.where(F.col(value).isNotNull()).groupBy(F.window(ts, slide).alias("__p"), *keys).agg(F.hll_sketch_agg(value, bits).alias("__s"))
    panes = panes.withColumn("__at", F.col("__p.start"))
    windows = panes.groupBy(F.window("__at", size, slide).alias("__w"), *keys)
    return _window_columns(windows.agg(F.hll_sketch_estimate(F.hll_union_agg("__s")).alias("n_about")))


def sessions(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    gap: str,
    aggs: list[Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Session windows: rows of a key at most ``gap`` apart belong together.

    Start flags and their running sum are hot-key safe, and the aggregate combines map-side.
    """
    ts = order[0]
    hot = probe_hot_keys(df, keys, ts, hot_rows, order[1] if len(order) > 1 else None)
    flagged = with_previous(df, keys, order, {"__prev_ts": ts}, hot=hot)
    breaks = F.col("__prev_ts").isNull() | (
        F.col(ts) - F.col("__prev_ts") > F.expr(f"interval {gap}")
    )
    flagged = flagged.withColumn("__new", F.when(breaks, 1).otherwise(0).cast("long")).drop("__prev_ts")
    flagged = between_scans(flagged, hot)
    numbered = running(flagged, keys, order, {"__session": Running("sum", F.col("__new"))}, hot=hot)
    return (
        numbered.groupBy(*keys, "__session")
        .agg(
            F.min(ts).alias("session_start"),
            (F.max(ts) + F.expr(f"interval {gap}")).alias("session_end"),
            *aggs,
        )
        .drop("__session")
    )


def count_window_avg(
    df: DataFrame, keys: list[str], order: list[str], value: str, n: int, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every n rows of a key: whole-number average as double; an incomplete last group is silent."""
    numbered = row_numbers(df, keys, order, "__rn", hot_rows)
    group = F.floor((F.col("__rn") - 1) / n).alias("window_no")
    quotient = F.expr(f"sum({value}) div {n}")
    return (
        numbered.groupBy(*keys, group)
        .agg(F.count(F.lit(1)).alias("__c"), quotient.cast("double").alias("avg_value"))
        .where(F.col("__c") == n)
        .drop("__c")
    )


def count_window_sliding(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    size: int,
    slide: int,
    aggs: list[Column],
    hot_rows: int = HOT_ROWS,
    partial: dict[str, Column] | None = None,
) -> DataFrame:
    """Fires at every ``slide``-th row of a key over the last ``size`` rows (fewer at the start).

    Each row is sent to the windows it belongs to, so windows of a hot key spread over tasks. With
    ``partial``, rows are summed up in panes first, as long as windows share their ends, and panes are
    sent instead; ``aggs`` then refer to the columns that ``partial`` names.
    """
    numbered = row_numbers(df, keys, order, "__rn", hot_rows).withColumn("__end", F.col("__rn"))
    if partial is not None:
        pane = math.gcd(size, slide)
        first_row = (F.floor((F.col("__rn") - 1) / pane) * pane + 1).alias("__rn")
        kept = [c.alias(n) for n, c in partial.items()]
        numbered = numbered.groupBy(*keys, first_row).agg(F.max("__end").alias("__end"), *kept)
    first = F.ceil(F.col("__rn") / slide) * slide
    last = F.floor((F.col("__rn") + size - 1) / slide) * slide
    ends = F.when(first <= last, F.sequence(first, last, F.lit(slide).cast("long")))
    spread = numbered.withColumn("window_end_row", F.explode(ends))
    return (
        spread.groupBy(*keys, "window_end_row")
        .agg(F.max("__end").alias("__last"), *aggs)
        .where(F.col("__last") == F.col("window_end_row"))
        .drop("__last")
    )


def word_count(df: DataFrame, text: str) -> DataFrame:
    return (
        df.select(F.explode(words(F.col(text))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def salted_agg(
    df: DataFrame,
    keys: list[str],
    partial: dict[str, Column],
    final: dict[str, Column],
    salts: int = 16,
    salt_on: list[str] | None = None,
) -> DataFrame:
    """Two-phase aggregate: per (key, salt), then per key.

    The salt is the number of the task that reads the row, or a hash of ``salt_on``, if given; it is
    never random. By task, a key leaves each task as one row, however few columns tell its rows
    apart, and no row is hashed for it. ``final`` refers to the columns named in ``partial``.
    """
    spread = F.xxhash64(*[F.col(c) for c in salt_on]) if salt_on else F.spark_partition_id()
    salted = df.withColumn("__salt", F.pmod(spread, F.lit(salts)))
    first = salted.groupBy(*keys, "__salt").agg(*[c.alias(n) for n, c in partial.items()])
    return first.groupBy(*keys).agg(*[c.alias(n) for n, c in final.items()])


def top_terms(df: DataFrame, field: str, size: int = 10) -> DataFrame:
    """Buckets of a field's values, largest first."""
    counts = df.groupBy(F.col(field).alias("key")).agg(F.count(F.lit(1)).alias("doc_count"))
    return counts.orderBy(F.desc("doc_count"), F.asc("key")).limit(size)


def last_n_values(
    df: DataFrame, keys: list[str], order: list[str], value: str, n: int
) -> DataFrame:
    """The last n values of each key, oldest first.

    The rank filter is applied before the shuffle too (window group limit), so a hot key sends at
    most n rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    recent = df.select(*dict.fromkeys([*keys, *order, value])).withColumn("__rk", F.row_number().over(w))
    entries = F.array_sort(F.collect_list(F.struct((-F.col("__rk")).alias("r"), F.col(value).alias("v"))))
    return (
        recent.where(F.col("__rk") <= n)
        .groupBy(*keys)
        .agg(F.transform(entries, lambda e: e["v"]).alias("last_values"))
    )
