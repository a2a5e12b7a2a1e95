"""Splitting one input into several outputs: by rule, by lateness, by validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import HOT_ROWS, Running, running


def with_route(
    df: DataFrame, routes: dict[str, Column], default: str | None = None, name: str = "route"
) -> DataFrame:
    """Tag each row with the first matching route; null where nothing matches and no default."""
    tag = F.lit(None).cast("string") if default is None else F.lit(default)
    for label, predicate in reversed(routes.items()):
        tag = F.when(predicate, F.lit(label)).otherwise(tag)
    return df.withColumn(name, tag)


def split_by(
    df: DataFrame, routes: dict[str, Column], default: str | None = None
) -> dict[str, DataFrame]:
    """One DataFrame per route; each is a plain filter, so it is pushed down to the scan."""
    tagged = with_route(df, routes, default, "__route")
    labels = [*routes, *([default] if default is not None and default not in routes else [])]
    return {label: tagged.where(F.col("__route") == label).drop("__route") for label in labels}


def write_routes(df: DataFrame, path: str, name: str = "route") -> None:
    """All routes in one pass over the input, one folder per route; unrouted rows are left out."""
    df.where(F.col(name).isNotNull()).write.mode("overwrite").partitionBy(name).parquet(path)


def two_level_route(
    df: DataFrame, first: str, second: str, wanted: dict[str, list[str]]
) -> DataFrame:
    """Keep rows whose first level is known and whose second level belongs to it; tag ``a/b``."""
    routes = {
        f"{a}/{b}": (F.col(first) == a) & (F.col(second) == b)
        for a, seconds in wanted.items()
        for b in seconds
    }
    return with_route(df, routes).where(F.col("route").isNotNull())


def watermark_trace(
    df: DataFrame, arrival: list[str], ts: str, delay: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``watermark``: the largest event time seen so far in arrival order, less the delay."""
    out = running(df, [], arrival, {"__max": Running("max", F.col(ts))}, hot_rows)
    return out.withColumn("watermark", F.col("__max") - F.expr(f"interval {delay}")).drop("__max")


def with_lateness(
    df: DataFrame,
    arrival: list[str],
    ts: str,
    size: str,
    delay: str,
    lateness: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add window bounds, watermark and ``is_late``: the window had closed for good on arrival."""
    traced = watermark_trace(df, arrival, ts, delay, hot_rows)
    w = F.window(ts, size)
    return traced.withColumns({"window_start": w["start"], "window_end": w["end"]}).withColumn(
        "is_late", F.col("window_end") + F.expr(f"interval {lateness}") <= F.col("watermark")
    )


def quarantine(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``reason``): the first failing check names the reason.

    A check that evaluates to null counts as failed.
    """
    failing = {name: ~F.coalesce(ok, F.lit(False)) for name, ok in checks.items()}
    tagged = with_route(df, failing, name="reason")
    return (
        tagged.where(F.col("reason").isNull()).drop("reason"),
        tagged.where(F.col("reason").isNotNull()),
    )
