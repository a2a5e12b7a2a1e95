"""A table seen commit by commit: stops between the steps, replays, and the files that a merge opens."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.committed import Table, merge_sink, slots_for, two_phase_sink
from millrace.session import scratch_path

SCHEMA = "id bigint, value string, day string"


def table(spark, slots=64):
    return Table(spark, scratch_path(spark, "t-committed"), "id", "day", SCHEMA, slots)


def rows(spark, ids, value="a", days=3):
    return spark.createDataFrame([(i, value, None if i % 11 == 0 else f"d {i % days}+%") for i in ids], SCHEMA)


def seen(t):
    return sorted((tuple(r) for r in t.read().collect()), key=repr)


def expected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_readers_see_whole_commits_only(spark):
    t = table(spark)
    assert seen(t) == [] and t.files() == []
    first, second = rows(spark, range(50)), rows(spark, range(50, 80), "b")
    t.append(first, "one")
    before = seen(t)
    assert before == expected(first)
    added = t.stage(second, "two")
    assert seen(t) == before  # staged
    t.pre_commit("two", added)
    assert seen(t) == before  # pre-committed
    t.commit("two")
    assert seen(t) == expected(first.union(second)) and t.commits() == [1, 2]
    t.append(second, "two")  # delivered again
    assert t.commits() == [1, 2]
    with pytest.raises(RuntimeError):
        t.abort("two")


def test_recovery_after_every_step(spark):
    first, second = rows(spark, range(30)), rows(spark, range(30, 60), "b")
    for step in ("staged", "pre-committed", "half a log"):
        t = table(spark)
        t.append(first, "one")
        added = t.stage(second, "two")
        if step != "staged":
            t.pre_commit("two", added)
        if step == "half a log":
            t._fs().delete(t._at("log", "_pending-two", "_SUCCESS"), False)
        t.recover()
        done = step == "pre-committed"
        assert t.has("two") == done
        assert seen(t) == expected(first.union(second) if done else first)
        assert t._names("data") == (["txn=one", "txn=two"] if done else ["txn=one"]) or sorted(t._names("data")) == ["txn=one", "txn=two"]
        two_phase = two_phase_sink(t)
        two_phase(rows(spark, range(60, 65)), 0)
        two_phase(rows(spark, range(60, 65)), 0)
        assert len(seen(t)) == (65 if done else 35)


def test_a_failed_merge_leaves_the_table_as_it_was(spark, monkeypatch):
    t = table(spark)
    t.append(rows(spark, range(40)), "one")
    before = seen(t)
    changes = rows(spark, range(20, 45), "new").withColumn("op", F.lit("upsert")).withColumn("seq", F.lit(1))
    monkeypatch.setattr(Table, "commit", lambda self, txn: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        t.merge(changes, ["seq"], "two")
    monkeypatch.undo()
    assert seen(t) == before
    t.abort("two")
    assert seen(t) == before
    merge_sink(t, ["seq"])(changes, 7)
    assert {r[0]: r[1] for r in seen(t)} == {i: "new" if i >= 20 else "a" for i in range(45)}


def test_merge_opens_only_files_that_may_hold_its_keys(spark):
    n = 20_000
    t = table(spark, slots_for(n) * 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wide = spark.range(n).select("id", F.lit("a").alias("value"), F.lit("d").alias("day"))
        t.append(wide, "one")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = t.files()
    assert len(files) >= 8
    few = spark.range(0, n, n // 3).select("id")  # four keys
    opened = t.files_with(few)
    holders = {r[0] for r in t.read().join(few, "id", "left_semi").select(F.input_file_name()).distinct().collect()}
    assert len(holders) <= len(opened) < len(files)
    assert {h.split("/data/")[1] for h in holders} <= set(opened)
    changes = few.select("id", F.lit("b").alias("value"), F.lit("e").alias("day"), F.when(F.col("id") == 0, "delete").otherwise("upsert").alias("op"), F.lit(1).alias("seq"))
    t.merge(changes, ["seq"], "two")
    assert set(files) - set(opened) == {f for f in t.files() if f.startswith("txn=one")}
    moved = {r["id"] for r in t.read().where("day = 'e'").collect()}
    assert moved == {r["id"] for r in few.collect()} - {0}
    assert t.read().count() == n - 1 and t.read().select("id").distinct().count() == n - 1


def test_no_key_is_missed(spark):
    t = table(spark, 4)
    t.append(rows(spark, range(3000), days=2), "one")
    for i in range(0, 3000, 331):
        opened = t.files_with(spark.createDataFrame([(i,)], "id bigint"))
        assert t.read(opened).where(F.col("id") == i).count() == 1
    assert t.files_with(spark.createDataFrame([], "id bigint")) == []
