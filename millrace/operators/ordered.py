"""Ordered scans per key that keep working when one key holds a large part of the rows.

A window such as ``sum() over (partition by key order by ts)`` puts every row of a key into one
task. `running` first asks which keys have more than ``hot_rows`` rows. Without any, the plain
window is used. The rows of a hot key are cut into time slices; each slice is scanned by its own
task and starts from a carry row that sums up all earlier slices of that key. The carry table has
one row per hot key and slice, so only that reduced table is ordered per key.

With no keys at all the whole table is one hot key, which gives global running values.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import broadcast_if_small
from millrace.session import cut_lineage

HOT_ROWS = 5_000_000
SLICES_PER_HOT_ROWS = 4  # slices are this much finer than needed, as quantiles are approximate
MIN_GLOBAL_SLICES = 64
PROBED_SLICES = MIN_GLOBAL_SLICES  # found in the pass that counts a table; larger tables take another pass
FEW_CUTS = 128  # looked up by nested conditions; more of them by a binary search
MOST_SLICES = 4096  # of one key; more rows make larger slices

_LEAST = -(1 << 63)
_CUTS = "array<struct<at: bigint, tie: bigint>>"
_TIE_TYPES = ("byte", "short", "integer", "long", "date", "timestamp", "timestamp_ntz")


@dataclass(frozen=True)
class Running:
    """A running aggregate; ``inclusive`` tells whether the current row takes part."""

    kind: str  # count, sum, min, max, last (last non-null)
    value: Column | None = None
    inclusive: bool = True


def position(df: DataFrame, name: str) -> Column:
    """An integer that grows with the column: microseconds for timestamps, days for dates,
    whole units for numbers."""
    kind = df.schema[name].dataType.typeName()
    c = F.col(name)
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind == "timestamp_ntz":
        days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
        seconds = F.hour(c) * 3600 + F.minute(c) * 60
        micros = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
        return (days * 86_400 + seconds) * 1_000_000 + micros
    if kind == "date":
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long")
    return F.floor(c).cast("long")


@dataclass(frozen=True)
class HotKeys:
    """What the probe found: which keys to cut, and at which positions."""

    keys: tuple[str, ...]
    order: str
    table: DataFrame | None  # hot keys with __cuts; None if the whole table is one key
    cuts: tuple[tuple[int, int], ...] = ()  # (position, tie) pairs
    tie: str | None = None

    def cut(self, df: DataFrame) -> DataFrame:
        """df with ``__slice`` (0 unless the key is hot) and ``__hot``."""
        places = df.withColumns(_place(df, self.order, self.tie))
        if self.table is None and len(self.cuts) <= FEW_CUTS:
            found = F.expr(f"case when __at is null then -1L else {_case_tree(self.cuts, 0, len(self.cuts))} end")
            return places.withColumns({"__slice": found, "__hot": F.lit(True)}).drop("__at", "__tie")
        if self.table is None:
            at, ties = (F.lit(np.array([c[i] for c in self.cuts], np.int64)) for i in (0, 1))
            cuts = (lambda i: F.get(at, i), lambda i: F.get(ties, i))
            return _with_slice(places, len(self.cuts), F.lit(len(self.cuts)), cuts).withColumn("__hot", F.lit(True))
        joined = places.join(self._table(), self._same_key(), "left").withColumn("__hot", F.col("__cuts").isNotNull())
        cuts = (lambda i: F.get("__cuts", i)["at"], lambda i: F.get("__cuts", i)["tie"])
        sliced = _with_slice(joined, 2 * MOST_SLICES, F.coalesce(F.size("__cuts"), F.lit(0)), cuts)
        return sliced.drop("__cuts", *[f"__hk_{k}" for k in self.keys])

    def only(self, df: DataFrame, hot: bool) -> DataFrame:
        """The rows of hot keys, or all others."""
        how = "left_semi" if hot else "left_anti"
        return df.join(self._table(), self._same_key(), how)

    def _table(self) -> DataFrame:
        return broadcast_if_small(self.table)

    def _same_key(self) -> Column:
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__hk_{k}"))
        return same


def probe_hot_keys(
    df: DataFrame, keys: list[str], order: str, hot_rows: int = HOT_ROWS, tie: str | None = None
) -> HotKeys | None:
    """Find keys with more than hot_rows rows: one map-side combined count per key.

    Where a key has many rows of the same position, those are cut along ``tie``, the next column of
    the order, if it is a whole number, a date or a timestamp.
    """
    where = position(df, order)
    tie = tie if tie is not None and df.schema[tie].dataType.typeName() in _TIE_TYPES else None
    if not keys:
        probe = df.agg(F.count(F.lit(1)).alias("n"), _quantiles(where, PROBED_SLICES).alias("cuts")).first()
        slices = _slices(probe["n"], hot_rows, MIN_GLOBAL_SLICES)
        if slices > PROBED_SLICES:
            probe = df.agg(_quantiles(where, slices).alias("cuts")).first()
        found = _thinned(probe["cuts"] or [], slices)
        crowds = [(at, n) for at, n in Counter(found).items() if n > 1]
        pairs = {(at, _LEAST) for at in found}
        if crowds and tie is not None:
            rows = df.select(where.alias("__at"), position(df, tie).alias("__tie"))
            crowds = df.sparkSession.createDataFrame(crowds, "__crowd bigint, __m bigint")
            more = _cuts_of_crowds(rows, crowds, [], slices).collect()  # fewer than twice the slices
            pairs.update((r["__at"], r["__tie"]) for r in more)
        return HotKeys((), order, None, tuple(sorted(pairs)), tie)

    # at most (rows / hot_rows) keys can pass this filter
    heavy = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows))
    most = heavy.agg(F.max("__n")).first()[0]
    if most is None:
        return None
    renamed = heavy.select(*[F.col(k).alias(f"__hk_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__hk_{k}"))
    ties = F.lit(None).cast("long") if tie is None else position(df, tie)
    rows = df.select(*keys, where.alias("__at"), ties.alias("__tie")).join(broadcast_if_small(renamed), same)
    hot, slices = renamed.columns, _slices(most, hot_rows)
    found = rows.groupBy(*hot).agg(_quantiles(F.col("__at"), slices).alias("__found"))
    found = cut_lineage(found.where("__found is not null"))
    cuts = found.select(*hot, F.explode(F.array_distinct("__found")).alias("__at"), F.lit(_LEAST).alias("__tie"))
    if tie is not None:
        crowds = found.select(*hot, F.explode("__found").alias("__at")).groupBy(*hot, "__at").agg(F.count("*").alias("__m"))
        crowds = crowds.where("__m > 1").toDF(*[f"__c{i}" for i in range(len(hot))], "__crowd", "__m")
        cuts = cuts.unionByName(_cuts_of_crowds(rows, crowds, hot, slices))
    # at most 2 * MOST_SLICES cuts of a key
    pairs = F.array_sort(F.collect_set(F.struct("__at", "__tie"))).cast(_CUTS)
    return HotKeys(tuple(keys), order, cut_lineage(cuts.groupBy(*hot).agg(pairs.alias("__cuts"))), tie=tie)


def _place(df: DataFrame, order: str, tie: str | None) -> dict[str, Column]:
    """Where a row stands, as two columns that compare like the first ones of the order; null ties first."""
    next_ = F.lit(_LEAST) if tie is None else F.coalesce(position(df, tie), F.lit(_LEAST))
    return {"__at": position(df, order), "__tie": next_.cast("long")}


def _cuts_of_crowds(rows: DataFrame, crowds: DataFrame, hot: list[str], slices: int) -> DataFrame:
    """Cuts along the tie where a position is several (``__m``) quantiles of its key: about as many."""
    same = F.col("__at") == F.col("__crowd")
    for i, k in enumerate(hot):
        same = same & F.col(k).eqNullSafe(F.col(f"__c{i}"))
    inside = rows.join(broadcast_if_small(crowds), same).groupBy(*hot, "__at", "__m")
    ties = inside.agg(_quantiles(F.col("__tie"), slices).alias("__ties"))
    step = F.greatest(F.lit(1), F.floor(F.lit(slices) / (F.col("__m") + 1)).cast("int"))
    thinned = F.filter("__ties", lambda _, i: (i + 1) % step == 0)
    return ties.select(*hot, "__at", F.explode(thinned).alias("__tie"))


def _slices(rows: int, hot_rows: int, least: int = 2) -> int:
    return min(MOST_SLICES, max(least, rows * SLICES_PER_HOT_ROWS // hot_rows))


def _thinned(cuts: list[int], slices: int) -> list[int]:
    """So many of the cuts, evenly, that they make about as many slices."""
    step = max(1, (len(cuts) + 1) // slices)
    return cuts[step - 1 :: step]


def _quantiles(where: Column, slices: int) -> Column:
    """Positions that cut the rows into slices of about equal numbers of rows, however they bunch."""
    shares = [i / slices for i in range(1, slices)]
    return F.percentile_approx(where, shares, max(10_000, 20 * slices))


def _case_tree(cuts: tuple[tuple[int, int], ...], low: int, high: int) -> str:
    """How many of a few cuts lie at or below the place, as nested conditions."""
    if low == high:
        return f"{low}L"
    middle = (low + high) // 2
    at, tie = cuts[middle]
    before = f"__at < {at}L" if tie == _LEAST else f"(__at < {at}L or (__at = {at}L and __tie < {tie}L))"
    return f"case when {before} then {_case_tree(cuts, low, middle)} else {_case_tree(cuts, middle + 1, high)} end"


def _with_slice(places: DataFrame, most: int, size: Column, cuts: tuple[Callable, Callable]) -> DataFrame:
    """``__slice``: how many of `size` <= `most` cuts lie at or below the place; -1 for a row without one.

    A binary search, one projection per step: a step uses what it finds twice, so Spark leaves them apart
    and compiles all of them into one loop. Inside a higher-order function they would be interpreted.
    """
    found = places.withColumn("__slice", F.lit(0))
    for bit in reversed(range(most.bit_length())):
        i = F.col("__slice") + ((1 << bit) - 1)
        at, tie = (cut(i) for cut in cuts)
        reached = (i < size) & ((at < F.col("__at")) | ((at == F.col("__at")) & (tie <= F.col("__tie"))))
        found = found.withColumn("__slice", F.col("__slice") + F.when(reached, 1 << bit).otherwise(0))
    by_place = F.when(F.col("__at").isNull(), -1).otherwise(F.col("__slice")).cast("long")
    return found.withColumn("__slice", by_place).drop("__at", "__tie")


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    specs: dict[str, Running],
    hot_rows: int = HOT_ROWS,
    hot: HotKeys | None | str = "probe",
) -> DataFrame:
    """Add one column per spec: its aggregate over the rows of the key up to this row.

    ``order`` must be a total order within a key for reproducible results; its first column (time
    or number, not null) is the one that hot keys are cut along, and the second where many rows share
    the first. ``hot`` takes the result of an
    earlier probe of the same keys.
    """
    values = {
        f"__v_{name}": F.lit(1).cast("long") if s.kind == "count" else s.value
        for name, s in specs.items()
    }
    rows = df.withColumns(values)
    part, sort = list(keys), [F.col(c) for c in order]
    if hot == "probe":
        hot = probe_hot_keys(df, keys, order[0], hot_rows, order[1] if len(order) > 1 else None)
    if hot is not None:
        part, sort = [*keys, "__slice"], [F.col("__first"), *sort]
        sliced = hot.cut(rows)
        rows = sliced.drop("__hot").withColumn("__first", F.lit(1))
        rows = rows.unionByName(_carry_rows(sliced, keys, order, specs), allowMissingColumns=True)

    w = Window.partitionBy(*part).orderBy(*sort)
    result = {}
    for name, s in specs.items():
        frame = w.rowsBetween(Window.unboundedPreceding, 0 if s.inclusive else -1)
        result[name] = _combine(s, F.col(f"__v_{name}")).over(frame)
        if s.kind == "count":
            result[name] = F.coalesce(result[name], F.lit(0).cast("long"))
    out = rows.withColumns(result)
    if hot is not None:
        out = out.where(F.col("__first") == 1)
    return out.drop(*values, "__slice", "__first")


def _combine(s: Running, value: Column) -> Column:
    if s.kind in ("count", "sum"):
        return F.sum(value)
    if s.kind == "min":
        return F.min(value)
    if s.kind == "max":
        return F.max(value)
    if s.kind == "last":
        return F.last(value, ignorenulls=True)
    raise ValueError(f"unknown running aggregate: {s.kind}")


def _carry_rows(
    sliced: DataFrame, keys: list[str], order: list[str], specs: dict[str, Running]
) -> DataFrame:
    """One row per hot key and slice holding what all earlier slices add up to."""
    totals = []
    for name, s in specs.items():
        v = F.col(f"__v_{name}")
        if s.kind == "last":
            # max_by over the order struct is combined map-side; null values never win
            at = F.when(v.isNotNull(), F.struct(*order))
            totals.append(F.max_by(v, at).alias(f"__v_{name}"))
        else:
            totals.append(_combine(s, v).alias(f"__v_{name}"))
    per_slice = sliced.where("__hot").groupBy(*keys, "__slice").agg(*totals)
    w = (
        Window.partitionBy(*keys)
        .orderBy("__slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = {
        f"__v_{name}": _combine(s, F.col(f"__v_{name}")).over(w) for name, s in specs.items()
    }
    return per_slice.withColumns(carried).withColumn("__first", F.lit(0))


def between_scans(df: DataFrame, hot: HotKeys | None) -> DataFrame:
    """Put between two scans of the same keys: with hot keys each scan reads its input twice (rows
    and carry), so the result of the scan before is written once instead of computed again."""
    return df if hot is None else cut_lineage(df)


def row_numbers(
    df: DataFrame, keys: list[str], order: list[str], name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """1, 2, 3, ... within each key."""
    return running(df, keys, order, {name: Running("count")}, hot_rows)


def with_previous(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: dict[str, str],
    hot_rows: int = HOT_ROWS,
    hot: HotKeys | None | str = "probe",
) -> DataFrame:
    """The previous row's columns (``{new name: column}``); null on the first row of a key."""
    row = F.struct(*[F.col(c).alias(new) for new, c in columns.items()])
    spec = {"__prev": Running("last", row, inclusive=False)}
    out = running(df, keys, order, spec, hot_rows, hot)
    return out.withColumns({new: F.col(f"__prev.{new}") for new in columns}).drop("__prev")
