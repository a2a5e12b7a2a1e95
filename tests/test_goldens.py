"""Small results that are known by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, rowkeys, status
from millrace.functions.text import lower_keys, words
from millrace.operators import aggs, alerts, cells, joins, routing, search


def test_worst_status(spark):
    rows = [
        ("001", "*****NN**NNNNNNNNNNNNNN/"),
        ("001", "*****NN**NNNNNNNNNNNNNNA"),
        ("001", "xx*****NN**NNNNNNNNNNNNNNN"),
        ("001", None),
        ("002", None),
    ]
    df = spark.createDataFrame(rows, "uid string, s string")
    got = {r.uid: r.w for r in df.groupBy("uid").agg(status.worst_status("s").alias("w")).collect()}
    assert got == {"001": "*****NN**NNNNNNNNNNNNNNA", "002": "/" * 24}


def test_worst_status_rejects_short_text(spark):
    df = spark.createDataFrame([("001", "***")], "uid string, s string")
    with pytest.raises(Exception, match="shorter than 24"):
        df.groupBy("uid").agg(status.worst_status("s")).collect()


def test_severity_and_grades(spark):
    df = spark.createDataFrame([("B",), ("/",), ("x",), ("",), ("M",), ("3",)], "c string")
    got = {r.c: (r.k, r.g) for r in df.select("c", status.status_rank(F.col("c")).alias("k"), status.status_grade(F.col("c")).alias("g")).collect()}
    assert got == {"B": (19, "8"), "/": (1, "."), "x": (0, None), "": (0, None), "M": (5, "0"), "3": (11, "3")}


def test_salted_count(spark):
    lines = ["you you"] * 7 + ["jump jump"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "line int, text string")
    exploded = df.select("line", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    out = aggs.salted_agg(exploded, ["word"], {"n": F.count(F.lit(1))}, {"n": F.sum("n")}, 3, ["line", "pos"])
    assert {r.word: r.n for r in out.collect()} == {"you": 14, "jump": 2}


def test_broadcast_left_keeps_misses_and_last_duplicate(spark):
    names = spark.createDataFrame([("001", "a"), ("002", "b"), ("003", "c")], "id string, name string")
    dim = spark.createDataFrame([("001", 1, "old"), ("001", 2, "new"), ("002", 1, "two")], "id string, v int, team string")
    out = joins.broadcast_left(names, dim, ["id"], ["v"])
    assert sorted((r.id, r.team or "") for r in out.collect()) == [("001", "new"), ("002", "two"), ("003", "")]


def test_broadcast_only_below_the_byte_limit(spark):
    big = spark.range(101)
    assert joins.broadcast_if_small(big, 100) is big
    assert joins.broadcast_if_small(big, 101 * 8) is not big


def test_count_window_avg(spark):
    rows = [
        ("class1", 1, 78), ("class1", 2, 100), ("class1", 3, 0), ("class1", 4, 100),
        ("class2", 1, 80), ("class2", 2, 60), ("class1", 5, 33),
    ]
    df = spark.createDataFrame(rows, "k string, seq long, v long")
    out = aggs.count_window_avg(df, ["k"], ["seq"], "v", 2)
    assert sorted((r.k, r.avg_value) for r in out.collect()) == [("class1", 50.0), ("class1", 89.0), ("class2", 70.0)]


def test_window_start(spark):
    df = spark.range(1).select(F.timestamp_seconds(F.lit(199)).alias("ts"))
    got = df.select(F.unix_seconds(dates.window_start(F.col("ts"), "15 seconds"))).first()[0]
    assert got == 195


def test_fuzzy_names(spark):
    names = ["zhangsan", "lisi", "wangwu", "wangwu1", "wangwu2", "wangwu3", "wangwu44", "wangwu555"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name for r in df.where(search.fuzzy("name", "wangwu", 2)).collect()}
    assert got == {"wangwu", "wangwu1", "wangwu2", "wangwu3", "wangwu44"}


CELLS = [
    ("ce_shi1", "author", "name", "nicholas", 1),
    ("ce_shi1", "author", "nickname", "lee", 1),
    ("ce_shi1", "article", "title", "t", 1),
    ("ce_shi2", "author", "name", "other", 0),
    ("ce_shi2", "author", "name", "spark", 1),
    ("ce_shi2", "author", "nickname", "hadoop", 1),
    ("ce_shi3", "article", "tag", "x", 1),
]


def _cells(spark):
    return spark.createDataFrame(CELLS, "row_key string, family string, qualifier string, value string, ts long")


def test_cell_filters(spark):
    df = _cells(spark)
    both = cells.all_filters(df, "author", "name", "spark", "name")
    assert [tuple(r) for r in both.select("row_key", "qualifier", "value").collect()] == [("ce_shi2", "name", "spark")]
    loose = cells.value_filter(df, "author", "name", "spark")
    assert {r.row_key for r in loose.collect()} == {"ce_shi2", "ce_shi3"}
    strict = cells.value_filter(df, "author", "name", "spark", filter_if_missing=True)
    assert {r.row_key for r in strict.collect()} == {"ce_shi2"}


def test_cell_range_scan_and_versions(spark):
    df = _cells(spark)
    scan = cells.range_scan(df, "ce_shi1", "ce_shi3", "author")
    assert sorted(tuple(r) for r in scan.collect()) == [("ce_shi1", "nicholas,lee"), ("ce_shi2", "spark,hadoop")]
    kept = cells.keep_versions(df, 1)
    assert kept.count() == 6 and kept.where("value = 'other'").count() == 0


def test_cell_delete_granularity(spark):
    marks = spark.createDataFrame(
        [("ce_shi1", None, None), ("ce_shi2", "author", "name"), ("ce_shi3", "article", None)],
        "row_key string, family string, qualifier string",
    )
    left = cells.delete(_cells(spark), marks)
    assert [(r.row_key, r.qualifier) for r in left.collect()] == [("ce_shi2", "nickname")]


def test_row_key_prefix_is_pushed_as_prefix():
    assert "StartsWith" in str(cells.row_key_matches("^abc")) or "startswith" in str(cells.row_key_matches("^abc")).lower()


def _events(spark, rows):
    df = spark.createDataFrame(rows, "id string, s long, v double")
    return df.select("id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), F.col("s").alias("seq"), "v")


def test_rate_blacklist_resets_at_local_midnight(spark):
    rows = [("u", 3600 + i, 0.0) for i in range(12)] + [("u", 16 * 3600 + i, 0.0) for i in range(10)]
    out = alerts.rate_blacklist(_events(spark, rows), "id", ["ts", "seq"], 10)
    assert sorted(r.n for r in out.collect()) == [11, 12]


def test_jump(spark):
    rows = [("a", i, v) for i, v in enumerate([30.0, 35.0, 50.0, 49.0])]
    out = alerts.jump(_events(spark, rows), ["id"], ["ts", "seq"], "v", 10.0)
    assert [(r.id, r.previous, r.v) for r in out.collect()] == [("a", 35.0, 50.0)]


@pytest.mark.parametrize(
    ("readings", "expected"),
    [
        ([(0, 20.0), (5, 21.0), (9, 21.0), (12, 22.0)], [10]),
        ([(0, 20.0), (5, 19.0), (12, 18.0)], []),
        ([(0, 20.0), (10, 19.0)], [10]),
    ],
)
def test_sustained_rise(spark, readings, expected):
    df = _events(spark, [("a", s, v) for s, v in readings])
    out = alerts.sustained_rise(df, "id", ["ts", "seq"], "v", 10)
    epoch = dt.datetime(1970, 1, 1)
    assert sorted(int((r.alert_at - epoch).total_seconds()) for r in out.collect()) == expected


def test_routes_at_the_boundary(spark):
    df = spark.createDataFrame([(29.9,), (30.0,), (30.1,)], "t double").orderBy("t")
    a = routing.with_route(df, {"low": F.col("t") < 30}, "high")
    b = routing.with_route(df, {"high": F.col("t") > 30}, "low")
    assert [r.route for r in a.collect()] == ["low", "high", "high"]
    assert [r.route for r in b.collect()] == ["low", "low", "high"]


def test_integer_text(spark):
    texts = ["12", "-3", "+", "", "1.0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.ok for r in df.select("t", status.is_integer_text(F.col("t")).alias("ok")).collect()}
    assert [got[t] for t in texts] == [True, True, True, True, False]


def test_string_hash(spark):
    df = spark.createDataFrame([("abc",), ("hello world",), ("",), ("中a",)], "t string")
    got = {r.t: r.h for r in df.select("t", rowkeys.string_hash(F.col("t")).alias("h")).collect()}
    assert got == {"abc": 96354, "hello world": 1794106052, "": 0, "中a": ord("中") * 31 + ord("a")}


def test_split_points(spark):
    rows = rowkeys.split_points(spark, 3).orderBy("region").collect()
    assert [r.split_point for r in rows] == ["0000|", "0001|", "0002|"]


def test_dates(spark):
    texts = ["2014-01-02", "2014-01-02 22:01:33:023", "2021-02-30", "x", None, " "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    c = F.col("t")
    got = [(bool(r.d), bool(r.dt)) for r in df.select(dates.is_valid_date(c).alias("d"), dates.is_valid_datetime(c).alias("dt")).collect()]
    assert got == [(True, False), (True, True), (False, False), (False, False), (False, False), (False, False)]
    parts = [r[0] for r in df.where("t is null or t = ' ' or t like '2014%'").select(dates.date_partition(c)).collect()]
    assert parts == ["2014/01/02", "2014/01/02", "9999/12/30", "9999/12/30"]
    with pytest.raises(Exception, match="not a date"):
        df.where("t = 'x'").select(dates.date_partition(c)).collect()


def test_local_text_to_millis(spark):
    df = spark.createDataFrame([("1970-01-01 08:00:01",)], "t string")
    assert df.select(dates.local_text_to_millis(F.col("t"))).first()[0] == 1000


def test_lower_keys_last_wins(spark):
    df = spark.range(1).select(F.create_map(F.lit("A"), F.lit("1"), F.lit("b"), F.lit("2"), F.lit("a"), F.lit("3")).alias("m"))
    assert df.select(lower_keys(F.col("m"))).first()[0] == {"a": "3", "b": "2"}


def test_words_drop_trailing_blanks(spark):
    df = spark.createDataFrame([("a  b ",)], "t string")
    assert df.select(words(F.col("t"))).first()[0] == ["a", "", "b"]


def test_bool_query_needs_one_should_without_must(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "n int, s string")
    should = [search.term("s", "x"), search.term("s", "y")]
    assert {r.n for r in df.where(search.bool_query(should=should)).collect()} == {1, 2}
    assert {r.n for r in df.where(search.bool_query(must=[search.in_range("n", gte=2)], should=should)).collect()} == {2, 3}
    assert {r.n for r in df.where(search.bool_query(must_not=[search.term("n", 2)])).collect()} == {1, 3}


def test_highlight_keeps_case_and_quotes_tags(spark):
    df = spark.createDataFrame([("Ring ring ringer",)], "t string")
    got = df.select(search.highlight("t", "ring", "<$1>", "</$>")).first()[0]
    assert got == "<$1>Ring</$> <$1>ring</$> ringer"
