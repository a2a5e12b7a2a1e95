"""Change feeds: parsing, merging, replay, moved partitions."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.session import scratch_path
from millrace.sources import files


def canal(kind, rows, es, seq, database="shop", table="t"):
    return json.dumps({"table": table, "type": kind, "data": rows, "database": database, "es": es, "id": seq, "isDdl": kind == "CREATE"})


MESSAGES = [
    canal("INSERT", [{"ID": "1", "Name": "a", "day": "2024-01-01"}, {"ID": "2", "Name": "b", "day": "2024-01-01"}], 1, 1),
    canal("UPDATE", [{"ID": "1", "Name": "a2", "day": "2024-01-02"}], 2, 2),
    canal("DELETE", [{"ID": "2", "Name": "b", "day": "2024-01-01"}], 3, 3),
    canal("INSERT", [{"ID": "2", "Name": "again", "day": ""}], 4, 4),
    canal("CREATE", [], 5, 5),
    canal("INSERT", [{"ID": "9", "Name": "other", "day": "2024-01-01"}], 6, 6, database="else"),
    canal("INSERT", [{"ID": "x", "Name": "no number"}], 7, 7),
    "{broken",
]
COLUMNS = {"id": "bigint", "name": "string", "day": "string"}


@pytest.fixture()
def changes(spark):
    raw = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    parsed = cdc.of_table(cdc.parse_canal(raw), "shop", "t")
    return cdc.change_rows(parsed, COLUMNS)


def test_parse_drops_what_is_no_row_change(changes):
    got = sorted((r.cdc_es, r.op, r.id, r.name, r.day) for r in changes.where("id is not null").collect())
    assert got == [
        (1, "upsert", 1, "a", "2024-01-01"),
        (1, "upsert", 2, "b", "2024-01-01"),
        (2, "upsert", 1, "a2", "2024-01-02"),
        (3, "delete", 2, "b", "2024-01-01"),
        (4, "upsert", 2, "again", ""),
    ]
    assert [(r.name, r.day) for r in changes.where("id is null").collect()] == [("no number", None)]


def test_last_change_wins_even_after_a_delete(changes):
    state = cdc.current_rows(changes.where("id is not null"), "id", ["cdc_es", "cdc_id", "cdc_pos"])
    assert sorted((r.id, r.name) for r in state.collect()) == [(1, "a2"), (2, "again")]


def _table(df):
    return sorted((r.id, r.name, r.part) for r in df.collect())


def test_merge_moves_partitions_and_can_be_replayed(spark):
    path = scratch_path(spark, "merge-test")
    base = spark.createDataFrame([(1, "a", "p1"), (2, "b", "p1"), (3, "c", "p2"), (4, "d", "p3")], "id long, name string, part string")
    cdc.overwrite_partitions(base, path, ["part"])
    untouched = {r[0] for r in spark.read.parquet(path).where("part = 'p3'").select("_metadata.file_path").collect()}
    changes = spark.createDataFrame(
        [("upsert", 1, 1, "a2", "p2"), ("upsert", 2, 3, "x", "p2"), ("delete", 3, 3, "x", "p2"), ("upsert", 4, 5, "new", "p9"), ("delete", 5, 2, "b", "p1")],
        "op string, seq long, id long, name string, part string",
    )
    expected = [(1, "a2", "p2"), (4, "d", "p3"), (5, "new", "p9")]
    for _ in range(2):
        cdc.merge_into(spark, path, changes, "id", ["seq"], "part")
        assert _table(spark.read.parquet(path)) == expected
    after = spark.read.parquet(path)
    assert {r.part for r in after.select("part").distinct().collect()} == {"p2", "p3", "p9"}
    assert {r[0] for r in after.where("part = 'p3'").select("_metadata.file_path").collect()} == untouched


def test_merge_keeps_null_and_padded_partitions(spark):
    kind = "op string, seq long, id long, name string, h string"
    for keys_move in (True, False):
        path = scratch_path(spark, "merge-edge")
        first = [("upsert", 1, 1, "a", None), ("upsert", 1, 2, "b", None), ("upsert", 1, 3, "c", "01"), ("upsert", 1, 4, "d", "02"), ("upsert", 1, 5, "e", "2024/01/16"), ("upsert", 1, 6, "f", "")]
        cdc.merge_into(spark, path, spark.createDataFrame(first, kind), "id", ["seq"], "h")  # creates the table
        more = [("upsert", 2, 9, "n", None), ("upsert", 2, 3, "c2", "01"), ("delete", 2, 4, "d", "02"), ("upsert", 2, 5, "e2", "2024/01/16")]
        for _ in range(2):
            cdc.merge_into(spark, path, spark.createDataFrame(more, kind), "id", ["seq"], "h", keys_move=keys_move)
        got = sorted((r.id, r.name, r.h) for r in files.read_partitioned(spark, path, "h").collect())
        assert got == [(1, "a", None), (2, "b", None), (3, "c2", "01"), (5, "e2", "2024/01/16"), (6, "f", None), (9, "n", None)]


def test_merge_does_not_depend_on_batch_boundaries(spark):
    rows = [("delete" if i % 5 == 4 else "upsert", i, i % 7, f"v{i}", f"p{i % 3}") for i in range(60)]
    changes = spark.createDataFrame(rows, "op string, seq long, id long, name string, part string")
    expected = _table(cdc.current_rows(changes, "id", ["seq"]).drop("seq"))
    empty = changes.drop("op", "seq").limit(0)
    for cuts in ((0, 60), (0, 13, 29, 60)):
        state = empty
        for lo, hi in zip(cuts, cuts[1:]):
            state = cdc.merge(state, changes.where((F.col("seq") >= lo) & (F.col("seq") < hi)), "id", ["seq"])
        assert _table(state) == expected


def test_changelog_and_group_counts(spark):
    before = spark.createDataFrame([(1, "x"), (2, "y")], "id long, kind string")
    after = spark.createDataFrame([(1, "y"), (2, "y"), (3, "x")], "id long, kind string")
    log = cdc.changelog(before, after, "id")
    assert sorted(tuple(r) for r in log.collect()) == [("+", 1, "y"), ("+", 3, "x"), ("-", 1, "x")]
    assert {r.kind: r.counts for r in cdc.group_counts_from_log(log, "kind").collect()} == {"y": 1}


def test_row_images(spark):
    row = "array<struct<name:string,value:string>>"
    entries = spark.createDataFrame(
        [
            (1, "ROWDATA", "UPDATE", [("a", "1"), ("b", None)], [("a", "2"), ("b", None)]),
            (2, "ROWDATA", "DELETE", [("a", "1")], None),
            (3, "ROWDATA", "INSERT", None, [("a", "1")]),
            (4, "TRANSACTIONEND", None, None, None),
        ],
        f"entry_id long, entry_type string, event_type string, before {row}, after {row}",
    )
    got = sorted((r.entry_id, r.image, r.name, r.value, r.updated) for r in cdc.row_images(entries).na.fill("null", ["value"]).collect())
    assert got == [
        (1, "after", "a", "2", True), (1, "after", "b", "null", False),
        (1, "before", "a", "1", False), (1, "before", "b", "null", False),
        (2, "before", "a", "1", False), (3, "after", "a", "1", True),
    ]
