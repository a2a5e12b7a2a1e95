"""SQL scripts, lineage, reconciliation, connector options."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, rowkeys, sql, status
from millrace.operators import lineage, recon, routing, search
from millrace.session import scratch_path
from millrace.sources import envelope, files, jdbc, sqlscript


def test_split_statements():
    text = "select ';' as a; -- no; cut\nselect \"x;y\" /* ; */ , `c;d`;;\n  ;select 'it\\'s;'"
    assert sqlscript.split_statements(text) == ["select ';' as a", 'select "x;y"   , `c;d`', "select 'it\\'s;'"]


def test_substitute_leaves_unknown_names():
    assert sqlscript.substitute("${a} ${b}", {"a": "1"}) == "1 ${b}"


def test_run_script(spark, tmp_path):
    file = tmp_path / "s.sql"
    file.write_text("create or replace temp view v as select ${data_date} as d;\nselect d + 1 as e from v;\n")
    last = sqlscript.run_sql_script(spark, sqlscript.read_script(spark, str(file)), {"data_date": "20240101"})[-1]
    assert last.first().e == 20240102


def test_worst_status_in_a_script(spark):
    text = """
    select uid, ${worst} as status24 from (
      select '001' as uid, '*****NN**NNNNNNNNNNNNNN/' as paymt24
      union all select '001', '*****NN**NNNNNNNNNNNNNNA'
      union all select '001', '*****NN**NNNNNNNNNNNNNNN') t
    group by t.uid;
    """
    (last,) = sqlscript.run_sql_script(spark, text, {"worst": status.worst_status_sql("paymt24")})
    assert [tuple(r) for r in last.collect()] == [("001", "*****NN**NNNNNNNNNNNNNNA")]


def test_sql_functions_equal_the_columns(spark):
    sql.register(spark)
    df = spark.createDataFrame([("B",), ("x",), ("",), ("2024-02-29",), ("2023-02-29",), ("2024-01-02 03:04:05",), ("-1",)], "c string")
    c = F.col("c")
    pairs = {
        "status_rank(c)": status.status_rank(c),
        "status_grade(c)": status.status_grade(c),
        "is_integer_text(c)": status.is_integer_text(c),
        "is_valid_date(c)": dates.is_valid_date(c),
        "is_valid_datetime(c)": dates.is_valid_datetime(c),
        "month_of(c)": dates.month_of(c),
    }
    for text, column in pairs.items():
        assert df.where(~F.expr(text).eqNullSafe(column)).count() == 0, text
    days = df.where("c = '' or is_valid_date(c)")
    assert days.where(F.expr("date_partition(c)") != dates.date_partition(c)).count() == 0


SCRIPTS = [
    ("create", "create table mart.daily as select t.day from (select o.day from shop.orders o join shop.items i on i.oid = o.oid join ref.people p on p.id = o.who) t"),
    ("with", "With Base as (select k from raw1 where k = '7'), other as (select k from raw2 x inner join raw3 y on x.k = y.k) insert overwrite table out.t9 partition(dt='d') select * from base cross join OTHER"),
    ("multi", "from (select a, b from feed where a = 2) f insert overwrite table out.one partition (dt='x') select a group by a insert overwrite table  out.two select b group by b"),
    ("noise", "select 'from a' from b -- join c\n; insert into d select * from e, f g, h where 1 /* from i */"),
    ("long", "insert into cat.db.t select * from cat.db.s"),
    ("list", "insert into z select (select max(v) from w) m, y from a1, (select extract(year from ts) n from a2) q, c1"),
    ("replace", "create or replace table y4 as select trim(both ' ' from v) from (a join b on a.k = b.k)"),
]


def test_lineage_of_usual_statements(spark):
    df = spark.createDataFrame(SCRIPTS, "script_id string, sql string")
    got = {(r.script_id, r.statement_no): (set(r.inputs), set(r.outputs), set(r.ctes)) for r in lineage.table_names(df).collect()}
    assert got == {
        ("create", 0): ({"shop.orders", "shop.items", "ref.people"}, {"mart.daily"}, set()),
        ("with", 0): ({"raw1", "raw2", "raw3"}, {"out.t9"}, {"Base", "other"}),
        ("multi", 0): ({"feed"}, {"out.one", "out.two"}, set()),
        ("noise", 0): ({"b"}, set(), set()),
        ("noise", 1): ({"e", "f", "h"}, {"d"}, set()),
        ("long", 0): ({"cat.db.s"}, {"cat.db.t"}, set()),
        ("list", 0): ({"w", "a1", "a2", "c1"}, {"z"}, set()),
        ("replace", 0): ({"a", "b"}, {"y4"}, set()),
    }


def test_downstream_follows_long_chains(spark):
    edges = spark.createDataFrame([(f"t{i}", f"t{i + 1}") for i in range(150)], "input_table string, output_table string").coalesce(1)
    roots = spark.createDataFrame([("t0",)], "table_name string").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = sorted(r.depth for r in lineage.downstream(edges, roots).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found == list(range(1, 151))


def test_ideographs_are_tokens(spark):
    df = spark.createDataFrame([("[0]小米手机 pro",), ("小 box",), ("大米",)], "title string")
    assert df.where(search.match("title", "小米")).count() == 3 and df.where(search.match("title", "手机")).count() == 1
    marked = [r[0] for r in df.select(search.highlight("title", "手机")).collect()]
    assert marked[0] == "[0]小米<em>手机</em> pro" and marked[2] == "大米"


def test_latest_partition_of_text_values(spark):
    path, ledger = scratch_path(spark, "by-part"), scratch_path(spark, "ledger")
    spark.createDataFrame([(1, None), (2, "01"), (3, "02")], "id int, h string").write.partitionBy("h").parquet(path)
    assert [tuple(r) for r in files.scan_latest_partition(spark, path, "h").collect()] == [(3, "02")]
    seen = []
    for _ in range(2):  # the second call stands for a restart
        files.follow_once(spark, path, "h", lambda df, v: seen.append((v, df.count())), ledger)
    spark.createDataFrame([(4, "03")], "id int, h string").write.mode("append").partitionBy("h").parquet(path)
    files.follow_once(spark, path, "h", lambda df, v: seen.append((v, df.count())), ledger)
    assert seen == [("02", 1), ("03", 1)]


def test_downstream_ends_on_cycles(spark, rows_of):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "input_table string, output_table string")
    roots = spark.createDataFrame([("a",)], "table_name string")
    assert rows_of(lineage.downstream(edges, roots)) == [("a", "b", 1), ("a", "c", 2), ("a", "d", 3)]
    assert rows_of(lineage.upstream(edges, spark.createDataFrame([("d",)], "table_name string"))) == [("d", "a", 3), ("d", "b", 2), ("d", "c", 1)]


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "x", 5), (1, "x", 6), (2, None, 7)], "id int, v string, etl int")
    b = spark.createDataFrame([(2, None, 9), (3, "z", 9)], "id int, v string, etl int")
    assert tuple(recon.compare("t", a, b, ["etl"]).first()) == ("t", 3, 2, 3, 1, 1, 3)
    assert tuple(recon.compare("t", a.limit(0), a.limit(0), ["etl"]).first()) == ("t", 0, 0, 0, 0, 0, 0)
    left, right = (spark.createDataFrame([(v,) for v in t], "v string") for t in ("xxy", "xyy"))
    assert tuple(recon.compare("t", left, right).first()) == ("t", 3, 3, 2, 0, 0, 2)
    with pytest.raises(ValueError, match="unlike"):
        recon.compare("t", a, left)
    assert recon.columns_except(a, ["id", "etl"]).columns == ["v"]


def test_partial_update_and_paging(spark):
    base = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "_id int, sex string, age int")
    patch = spark.createDataFrame([(2, "f")], "_id int, sex string")
    assert sorted(tuple(r) for r in search.update_documents(base, patch, "_id").collect()) == [(1, "a", 10), (2, "f", 20)]
    paged = search.page_with_total(spark.range(25), [F.asc("id")], 2, 10)
    assert [tuple(r) for r in paged.orderBy("id").collect()] == [(i, 25) for i in range(20, 25)]


def test_jdbc_options():
    scan = jdbc.scan_options("jdbc:x", "t", "id", 1, 100, 8)
    assert scan["partitionColumn"] == "id" and scan["numPartitions"] == "8"
    assert jdbc.query_options("jdbc:x", "select 1") == {"url": "jdbc:x", "query": "select 1"}
    assert jdbc.append_options("jdbc:x", "t", 50)["batchsize"] == "50"
    with pytest.raises(ValueError, match="lower"):
        jdbc.scan_options("jdbc:x", "t", "id")


def test_kafka_options():
    options = envelope.kafka_options("h:1", ["a", "b"], {"a": {0: 5}}, 10)
    assert options["startingOffsets"] == '{"a": {"0": 5}}'
    assert options["subscribe"] == "a,b" and options["maxOffsetsPerTrigger"] == "10"


def test_routes_are_written_in_one_pass(spark):
    df = routing.with_route(spark.range(10), {"low": F.col("id") < 3, "high": F.col("id") > 6})
    path = scratch_path(spark, "routes")
    routing.write_routes(df, path)
    got = {r.route: r["count"] for r in spark.read.parquet(path).groupBy("route").count().collect()}
    assert got == {"low": 3, "high": 3}


def test_regions_are_sorted_ranges(spark):
    df = spark.range(1000).select(rowkeys.salted_row_key(F.col("id").cast("string"), 8).alias("row_key"))
    path = scratch_path(spark, "regions")
    rowkeys.write_regions(df, "row_key", path, 4)
    files = spark.read.parquet(path).groupBy("_metadata.file_name").agg(F.min("row_key").alias("lo"), F.max("row_key").alias("hi"))
    ranges = sorted((r.lo, r.hi) for r in files.collect())
    assert len(ranges) == 4 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert {r[0] for r in df.select(rowkeys.region_of(F.col("row_key"))).distinct().collect()} == set(range(8))


def test_packing_restores_the_settings(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    source, target = scratch_path(spark, "tiny"), scratch_path(spark, "packed")
    spark.range(40).select(F.col("id").cast("string")).repartition(40).write.text(source)
    files.pack_small_files(spark, source, target, "*.txt")
    packed = spark.read.parquet(target)
    assert packed.count() > 1 and len(packed.inputFiles()) == 1
    assert sorted(int(r.value) for r in files.unpack_lines(packed).collect()) == list(range(40))
    assert [spark.conf.get(n) for n in names] == before


def test_two_patches_of_one_id_are_an_error(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    patch = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (None, "w")], "id int, name string")
    with pytest.raises(Exception, match="several patches of id 1"):
        search.update_documents(base, patch, "id").collect()
    kept = search.update_documents(base, patch.where("name <> 'y'"), "id").collect()
    assert sorted(tuple(r) for r in kept) == [(1, "x"), (2, "b")]


def test_pages_by_offset_end_at_a_stated_depth(spark):
    rows = spark.range(20)
    with pytest.raises(ValueError, match="page_after"):
        search.page(rows, [F.asc("id")], search.DEEPEST, 1)
    assert [r.id for r in search.page_after(rows, "id", 16, 10).collect()] == [17, 18, 19]


def test_topic_rows_carry_their_key(spark):
    from millrace.sources.envelope import topic_rows

    rows = spark.createDataFrame([(7, "a", 1)], "key int, value string, extra int")
    assert [tuple(r) for r in topic_rows(rows).collect()] == [("7", "a")]
    assert topic_rows(rows.drop("key")).columns == ["value"]


def test_default_salt_on_one_column(spark):
    from millrace.operators import aggs

    words = spark.range(1000, numPartitions=4).select(F.lit("x").alias("word"))
    out = aggs.salted_agg(words, ["word"], {"n": F.count("*")}, {"n": F.sum("n")}, 4)
    assert [tuple(r) for r in out.collect()] == [("x", 1000)]
