"""Operators give the same rows whether or not the keys are cut into slices."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.text import words
from millrace.operators import aggs, alerts, joins, ordered, routing
from millrace.operators.ordered import Running

ORDER = ["ts", "event_id"]
NEVER = 10**9


@pytest.fixture(scope="module")
def events(spark, sf):
    """One user holds a third of all rows; some rows have no user."""
    df = spark.read.parquet(f"{sf}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, 7).when(F.col("event_id") % 50 == 1, None)
    key = F.when(F.col("event_id") % 50 == 1, None).otherwise(F.coalesce(hot, F.col("user_id")))
    return df.withColumn("user_id", key).withColumn("k", F.get_json_object("props", "$.k").cast("long")).cache()


def both(rows_of, fn):
    plain, cut = rows_of(fn(NEVER).fillna(-1)), rows_of(fn(20).fillna(-1))
    assert plain == cut
    assert plain
    return plain


def test_probe_finds_hot_keys_only(events):
    hot = ordered.probe_hot_keys(events, ["user_id"], "ts", 100)
    assert [r["__hk_user_id"] for r in hot.table.collect()] == [7]
    assert ordered.probe_hot_keys(events, ["user_id"], "ts", NEVER) is None


def test_hot_key_is_spread_over_slices(events):
    cut = ordered.probe_hot_keys(events, ["user_id"], "ts", 20).cut(events)
    sizes = cut.where("user_id = 7").groupBy("__slice").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 20 and sizes[1] > 10


def test_a_burst_is_cut_too(spark):
    """19,000 of 20,000 rows fall into one second of a day."""
    at = F.when(F.col("id") < 19_000, F.col("id") * 50).otherwise((F.col("id") - 19_000) * 86_000_000)
    burst = spark.range(20_000).select("id", F.lit(1).alias("k"), F.timestamp_micros(at + 43_200_000_000).alias("ts"))
    for keys in (["k"], []):
        sizes = ordered.probe_hot_keys(burst, keys, "ts", 1000).cut(burst).groupBy("__slice").count()
        assert sizes.agg(F.max("count")).first()[0] <= 1000
        cut = ordered.running(burst, keys, ["ts", "id"], {"n": Running("count")}, 1000)
        assert sorted(r.n for r in cut.collect()) == list(range(1, 20_001))


def test_rows_of_one_instant_are_cut_too(spark):
    """19,000 of 20,000 rows have the very same time; some of them have no tie value."""
    at = F.when(F.col("id") < 19_000, F.lit(500_000)).otherwise((F.col("id") - 18_999) * 1_000_000)
    seq = F.when(F.col("id") > 5, F.col("id") * 3)
    crowd = spark.range(20_000).select("id", F.lit(1).alias("k"), F.timestamp_micros(at).alias("ts"), seq.alias("seq"))
    for keys in (["k"], []):
        sizes = ordered.probe_hot_keys(crowd, keys, "ts", 1000, "seq").cut(crowd).groupBy("__slice").count()
        assert sizes.agg(F.max("count")).first()[0] <= 1000
        order = ["ts", "seq", "id"]
        cut = ordered.running(crowd, keys, order, {"n": Running("count"), "last": Running("last", F.col("id"), False)}, 1000)
        got = [(r.id, r.n, r.last) for r in cut.collect()]
        assert sorted(got) == [(i, i + 1, i - 1 if i else None) for i in range(20_000)]


def test_all_kinds(events, rows_of):
    specs = {
        "n": Running("count"),
        "before": Running("count", inclusive=False),
        "total": Running("sum", F.col("k")),
        "low": Running("min", F.col("k")),
        "high": Running("max", F.col("k"), inclusive=False),
        "last_small": Running("last", F.when(F.col("k") < 10, F.col("k"))),
    }
    cols = ["event_id", *specs]
    both(rows_of, lambda hot: ordered.running(events, ["user_id"], ORDER, specs, hot).select(cols))


def test_previous_row(events, rows_of):
    both(
        rows_of,
        lambda hot: ordered.with_previous(events, ["user_id"], ORDER, {"pv": "value"}, hot).select("event_id", "pv"),
    )


def test_global_running(events):
    out = ordered.row_numbers(events, [], ORDER, "rn")
    assert out.where(F.col("rn") != F.col("event_id") + 1).count() == 0
    assert out.count() == events.count()


def test_global_running_on_empty_input(events):
    assert ordered.row_numbers(events.where("event_id < 0"), [], ORDER, "rn").count() == 0


def test_asof(events, rows_of):
    left = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = events.where("event_type = 'signup'").select("event_id", "user_id", "ts", "value")
    for how in ("inner", "left"):
        rows = both(
            rows_of,
            lambda hot: joins.asof_join(
                left, right, ["user_id"], "ts", "ts", {"v": "value", "vid": "event_id"}, ["event_id"], how, hot
            ).drop("ts"),
        )
    assert len(rows) == left.count()


def test_sessions(events, rows_of):
    n = F.count(F.lit(1)).alias("n")
    both(
        rows_of,
        lambda hot: aggs.sessions(events, ["user_id"], ORDER, "2 hours", [n], hot)
        .drop("session_end")
        .withColumn("session_start", F.col("session_start").cast("string")),
    )


def test_count_windows(events, rows_of):
    both(rows_of, lambda hot: aggs.count_window_avg(events, ["user_id"], ORDER, "k", 2, hot))
    both(
        rows_of,
        lambda hot: aggs.count_window_sliding(events, ["user_id"], ORDER, 10, 3, [F.sum("k").alias("s")], hot),
    )


@pytest.mark.parametrize(("size", "slide"), [(10, 2), (10, 4), (9, 6), (3, 7), (5, 5)])
def test_panes_give_the_same_count_windows(events, rows_of, size, slide):
    plain = aggs.count_window_sliding(events, ["user_id"], ORDER, size, slide, [F.sum("k").alias("s"), F.min("k").alias("low")])
    partial = {"s": F.sum("k"), "low": F.min("k")}
    final = [F.sum("s").alias("s"), F.min("low").alias("low")]
    panes = aggs.count_window_sliding(events, ["user_id"], ORDER, size, slide, final, 20, partial)
    assert rows_of(panes.fillna(-1)) == rows_of(plain.fillna(-1))


def test_alerts(events, rows_of):
    both(rows_of, lambda hot: alerts.jump(events, ["user_id"], ORDER, "value", 10.0, hot).select("event_id", "previous"))
    both(rows_of, lambda hot: alerts.rate_blacklist(events, "user_id", ORDER, 5, 8, hot).select("event_id", "n"))
    both(
        rows_of,
        lambda hot: alerts.inactivity(events, ["user_id"], ORDER, "5 hours", None, hot).select(
            "user_id", F.col("alert_at").cast("string")
        ),
    )


def test_lateness(events, rows_of):
    moved = events.withColumn("arrival", F.col("ts") + F.make_dt_interval(secs=F.pmod(F.col("event_id") * 7919, F.lit(7200))))

    def late(hot):
        out = routing.with_lateness(moved, ["arrival", "event_id"], "ts", "1 hour", "2 seconds", "60 seconds", hot)
        return out.select("event_id", F.col("is_late").cast("int"), F.col("watermark").cast("string"))

    rows = both(rows_of, late)
    assert 0 < sum(r[1] for r in rows) < len(rows)


def one_by_one_rise(readings, wait, until=None):
    """One reading after the other, as a state machine."""
    alerts_, previous, timer, last = [], None, None, None
    for at, value in readings:
        if timer is not None and timer <= at:
            alerts_.append(timer)
            timer = None
        rises = value > (previous if previous is not None else 0)
        if rises and timer is None:
            timer = at + wait
        elif previous is not None and value < previous:
            timer = None
        previous, last = value, at
    if timer is not None and until is not None and timer <= max(until, last):
        alerts_.append(timer)
    return alerts_


def rise_on_spark(spark, keyed, wait, hot_rows, until=None):
    rows = [(k, at, i, v) for k, readings in keyed.items() for i, (at, v) in enumerate(readings)]
    df = spark.createDataFrame(rows, "k string, s long, event_id long, v double")
    df = df.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    end = None if until is None else F.timestamp_seconds(F.lit(until)).cast("timestamp_ntz")
    out = alerts.sustained_rise(df, "k", ORDER, "v", wait, end, hot_rows=hot_rows)
    epoch = dt.datetime(1970, 1, 1)
    got = {k: [] for k in keyed}
    for r in out.collect():
        got[r.k].append(int((r.alert_at - epoch).total_seconds()))
    return {k: sorted(v) for k, v in got.items()}


@pytest.mark.parametrize("hot_rows", [NEVER, 40, 8])
@pytest.mark.parametrize("until", [None, 10_000])
def test_sustained_rise_against_the_state_machine(spark, hot_rows, until):
    rng = random.Random(5)
    keyed = {}
    for k, (n, falls) in {"a": (300, 0.0), "b": (300, 0.02), "c": (60, 0.3), "d": (5, 0.5)}.items():
        at, value, readings = 0, 1.0, []
        for _ in range(n):
            at += rng.choice([1, 1, 2, 3, 25])
            value += -1 if rng.random() < falls else rng.choice([0, 1])
            readings.append((at, value))
        keyed[k] = readings
    expected = {k: one_by_one_rise(r, 10, until) for k, r in keyed.items()}
    assert rise_on_spark(spark, keyed, 10, hot_rows, until) == expected


def test_one_endless_rise_is_solved_by_jumps(spark):
    """A counter that never falls and never pauses: one run of 500 rises."""
    readings = [(i, float(i + 1)) for i in range(500)]
    assert rise_on_spark(spark, {"a": readings}, 7, 20)["a"] == one_by_one_rise(readings, 7)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(salts=st.integers(1, 40))
def test_salting_changes_nothing(spark, sf, rows_of, salts):
    docs = spark.read.parquet(f"{sf}/benchmark.parquet")
    exploded = docs.select("item_id", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    n = F.count(F.lit(1))
    salted = aggs.salted_agg(exploded, ["word"], {"n": n}, {"n": F.sum("n")}, salts, ["item_id", "pos"])
    assert rows_of(salted.select("word", "n")) == rows_of(aggs.word_count(docs, "text").select("word", "n"))
