"""Keyed alerts over ordered readings; the batch twins of the stream processors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from millrace.operators.ordered import (
    HOT_ROWS,
    Running,
    between_scans,
    probe_hot_keys,
    row_numbers,
    running,
    with_previous,
)
from millrace.session import cut_lineage

_BLOCK = 1000


def jump(
    df: DataFrame, keys: list[str], order: list[str], value: str, threshold: float, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows whose value differs from the key's previous one by more than the threshold."""
    out = with_previous(df, keys, order, {"previous": value}, hot_rows)
    return out.where(F.abs(F.col(value) - F.col("previous")) > threshold)


def rate_blacklist(
    df: DataFrame, user: str, order: list[str], limit: int, offset_hours: int = 8, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Events of a user beyond the limit within one local day, with ``local_day`` and ``n``."""
    day = (F.col(order[0]) + F.expr(f"interval {offset_hours} hours")).cast("date")
    counted = row_numbers(df.withColumn("local_day", day), [user, "local_day"], order, "n", hot_rows)
    return counted.where(F.col("n") > limit)


def inactivity(
    df: DataFrame, keys: list[str], order: list[str], wait: str, until: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(keys, last_ts, alert_at) where a key is silent for longer than the wait.

    With ``until`` (how far time has moved on) the silence after a key's last row counts as well.
    """
    ts, step = order[0], F.expr(f"interval {wait}")
    pairs = with_previous(df.select(*dict.fromkeys([*keys, *order])), keys, order, {"last_ts": ts}, hot_rows)
    gaps = pairs.where(F.col(ts) - F.col("last_ts") > step).select(*keys, "last_ts")
    if until is not None:
        ends = df.groupBy(*keys).agg(F.max(ts).alias("last_ts"))
        gaps = gaps.unionByName(ends.where(until >= F.col("last_ts") + step))
    return gaps.withColumn("alert_at", F.col("last_ts") + step)


def sustained_rise(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    seconds: int,
    until: Column | None = None,
    first_reading_starts: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(key, alert_at): a rise starts a timer of N seconds, a fall cancels it, a fired timer alerts
    and the next rise may start another; equal values change nothing.

    The readings of a key are cut into runs: at every fall, and at every rise that comes N seconds
    or more after the last one (any timer has fired by then). Within a run the timers follow from
    the times of its rises alone. Runs of ordinary keys hold at most ``hot_rows`` rises and are
    folded as arrays; longer runs of hot keys are solved by doubling jumps between rises.
    """
    ts, wait = order[0], F.expr(f"interval {seconds} seconds")
    rows = df.select(*dict.fromkeys([key, *order, value]))
    hot = probe_hot_keys(rows, [key], ts, hot_rows, order[1] if len(order) > 1 else None)
    rows = with_previous(rows, [key], order, {"__pv": value}, hot=hot)
    starts = F.col("__pv").isNull() & F.lit(first_reading_starts) & (F.col(value) > 0)
    rise = F.coalesce(F.col(value) > F.col("__pv"), starts)
    rows = between_scans(rows.withColumn("__rise", F.when(rise, F.col(ts))), hot)
    rows = running(
        rows, [key], order, {"__last_rise": Running("last", F.col("__rise"), inclusive=False)}, hot=hot
    )
    fall = F.coalesce(F.col(value) < F.col("__pv"), F.lit(False))
    pause = F.coalesce(F.col("__rise") - F.col("__last_rise") >= wait, F.lit(False))
    rows = rows.withColumn("__cut", F.when(fall | pause, 1).otherwise(0).cast("long"))
    rows = between_scans(rows.drop("__pv", "__last_rise", value), hot)
    rows = running(rows, [key], order, {"__run": Running("sum", F.col("__cut"))}, hot=hot)

    # a cutting row also marks the end of the run before it
    here = F.struct(
        F.col("__run").alias("run"), F.col("__rise").alias("rise"), F.lit(None).cast(df.schema[ts].dataType).alias("ended")
    )
    before = F.struct(
        (F.col("__run") - 1).alias("run"), F.lit(None).cast(df.schema[ts].dataType).alias("rise"), F.col(ts).alias("ended")
    )
    both = F.when(F.col("__cut") == 1, F.array(here, before)).otherwise(F.array(here))
    marks = rows.select(key, F.col(ts).alias("seen"), F.explode(both).alias("m")).select(
        key, "m.run", "m.rise", "m.ended", "seen"
    )
    ended = F.coalesce(F.max("ended"), F.greatest(F.max("seen"), until) if until is not None else F.max("seen"))
    if hot is None:
        return _fold_runs(marks, key, ended, wait)
    marks = cut_lineage(marks)
    sizes = hot.only(marks, hot=True).groupBy(key, "run").agg(F.count("rise").alias("n"))
    long_runs = cut_lineage(sizes.where(F.col("n") > hot_rows).select(key, "run"))
    if long_runs.isEmpty():
        return _fold_runs(marks, key, ended, wait)
    on = [F.col(key).eqNullSafe(F.col("__lk")), F.col("run") == F.col("__lr")]
    long_keys = long_runs.select(F.col(key).alias("__lk"), F.col("run").alias("__lr"))
    short = marks.join(long_keys, on, "left_anti")
    large = marks.join(long_keys, on, "left_semi")
    return _fold_runs(short, key, ended, wait).unionByName(
        _double_jumps(large, key, ended, wait, hot_rows)
    )


def _fold_runs(marks: DataFrame, key: str, ended: Column, wait: Column) -> DataFrame:
    runs = marks.groupBy(key, "run").agg(
        F.array_sort(F.collect_list("rise")).alias("rises"), ended.alias("ended")
    )
    runs = runs.where(F.size("rises") > 0)
    times = runs.schema["rises"].dataType
    # fired timers are gathered in blocks, so that appending to a long list stays cheap
    start = F.struct(
        F.array().cast(ArrayType(times)).alias("full"),
        F.array().cast(times).alias("block"),
        F.lit(None).cast(times.elementType).alias("last"),
    )

    def step(acc: Column, t: Column) -> Column:
        fresh = acc["last"].isNull() | (t >= acc["last"])
        done = F.size(acc["block"]) >= _BLOCK
        one = F.array(t + wait)
        return F.when(
            fresh,
            F.struct(
                F.when(done, F.concat(acc["full"], F.array(acc["block"]))).otherwise(acc["full"]).alias("full"),
                F.when(done, one).otherwise(F.concat(acc["block"], one)).alias("block"),
                (t + wait).alias("last"),
            ),
        ).otherwise(acc)

    fired = F.aggregate(
        "rises", start, step, lambda acc: F.concat(F.flatten(acc["full"]), acc["block"])
    )
    due = F.filter(fired, lambda t: t <= F.col("ended"))
    return runs.select(key, F.explode(due).alias("alert_at"))


def _double_jumps(
    marks: DataFrame, key: str, ended: Column, wait: Column, hot_rows: int
) -> DataFrame:
    """Timer starts of very long runs: jump[t] is the first rise at or after t + wait, and the
    starts are what the first rise reaches; each round doubles the length of the jumps."""
    ends = cut_lineage(marks.groupBy(key, "run").agg(ended.alias("ended"), F.min("rise").alias("t")))
    rises = marks.where(F.col("rise").isNotNull()).select(key, "run", F.col("rise").alias("t")).distinct()
    asks = rises.select(key, "run", (F.col("t") + wait).alias("at"), F.col("t").alias("asked"), F.lit(1).alias("side"))
    given = rises.select(key, "run", F.col("t").alias("at"), F.lit(None).cast(rises.schema["t"].dataType).alias("asked"), F.lit(0).alias("side"))
    stacked = given.unionByName(asks)
    epoch = F.lit("1970-01-01").cast("date")
    backwards = -(
        (F.datediff(F.col("at").cast("date"), epoch).cast("long") * 86_400 + F.hour("at") * 3600 + F.minute("at") * 60) * 1_000_000
        + (F.date_part(F.lit("SECOND"), F.col("at")) * 1_000_000).cast("long")
    )
    stacked = stacked.withColumn("back", backwards)
    nearest = Running("last", F.when(F.col("side") == 0, F.col("at")))
    linked = running(stacked, [key, "run"], ["back", "side"], {"next": nearest}, hot_rows)
    jumps = cut_lineage(
        linked.where((F.col("side") == 1) & F.col("next").isNotNull()).select(
            key, "run", F.col("asked").alias("t"), "next"
        )
    )
    reached = ends.select(key, "run", "t")
    while not jumps.isEmpty():
        step = reached.join(jumps, [key, "run", "t"]).select(key, "run", F.col("next").alias("t"))
        reached = cut_lineage(reached.unionByName(step))
        onward = jumps.select(key, "run", F.col("t").alias("next"), F.col("next").alias("next2"))
        jumps = cut_lineage(
            jumps.join(onward, [key, "run", "next"]).select(key, "run", "t", F.col("next2").alias("next"))
        )
    alerts = reached.join(ends.select(key, "run", "ended"), [key, "run"])
    return alerts.where(F.col("t") + wait <= F.col("ended")).select(
        key, (F.col("t") + wait).alias("alert_at")
    )
