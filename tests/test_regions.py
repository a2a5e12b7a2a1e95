"""Regions: what scans and gets return, and which files they open."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggs
from millrace.operators.regions import Regions, split_points, with_region
from millrace.session import scratch_path


@pytest.fixture(scope="module")
def cells(spark):
    rows = spark.range(20_000).select(F.format_string("%05d", F.pmod(F.col("id") * 7919, F.lit(10_000))).alias("row_key"), F.col("id").alias("value"))
    hot = spark.range(10_000).select(F.lit("04999").alias("row_key"), F.col("id").alias("value"))
    none = spark.createDataFrame([(None, 1)], "row_key string, value bigint")
    return rows.union(hot).union(none)


@pytest.fixture(scope="module")
def table(spark, cells):
    return Regions(spark, scratch_path(spark, "t-regions"), "row_key").write(cells, 10)


def files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def opened(df):
    return len(df.inputFiles())


def test_scans_open_overlapping_regions_only(table, cells):
    everything = opened(table.scan())
    assert table.scan().count() == cells.count() and table.splits().count() >= 8
    some = table.scan("01000", "01100")
    assert sorted(some.collect()) == sorted(cells.where("row_key >= '01000' and row_key < '01100'").collect())
    # the planner's file listing after partition filters
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan or "region" in plan.split("PartitionFilters")[1][:80]
    assert len(files(some)) <= 2 < everything
    assert len(files(table.scan("01000", "03000"))) < everything
    assert table.scan("2").count() == 0 and table.scan(None, "00010").count() == 20
    assert table.scan_prefix("012").count() == 200


def test_gets_open_their_regions(spark, table, cells):
    keys = spark.createDataFrame([("00007",), ("00008",), ("zzz",), (None,)], "row_key string")
    got = table.get(keys)
    assert sorted(got.collect()) == sorted(cells.where("row_key in ('00007', '00008')").collect())
    assert len(files(got)) == 1


def test_hot_row_stays_in_one_region(table):
    rows = {r["region"]: r for r in table.splits().collect()}
    assert sum(r["low"] is not None and r["low"] <= "04999" <= r["high"] for r in rows.values()) == 1
    assert table.scan("04999", "05000").count() == 10_002


def test_split_points_and_places(spark):
    df = spark.createDataFrame([(k,) for k in "aabbccddeeff"], "k string")
    assert split_points(df, "k", 3) == ["c", "e"]
    assert split_points(df.where("false"), "k", 3) == [] and split_points(df.where("k = 'a'"), "k", 4) == []
    placed = {r["k"]: r["region"] for r in with_region(df, "k", ["b", "d", "e"]).collect()}
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 2, "e": 3, "f": 3}


def test_sketches_of_panes(spark):
    rows = spark.range(20_000).select(F.timestamp_seconds(F.col("id") * 30).alias("ts"), F.concat(F.lit("v"), F.col("id") % 4001).alias("v"), (F.col("id") % 2).alias("k"))
    rows = rows.union(rows.limit(100))
    about = aggs.sliding_sketch_distinct(rows, "ts", "6 hours", "1 hour", ["k"], "v")
    exact = aggs.sliding(rows, "ts", "6 hours", "1 hour", ["k"], [F.count_distinct("v").alias("n")])
    both = about.join(exact, ["window_start", "window_end", "k"]).collect()
    assert len(both) == exact.count() == about.count()
    assert all(abs(r["n_about"] - r["n"]) <= 3 * aggs.sketch_error() * r["n"] for r in both)
