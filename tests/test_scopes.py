"""Lineage by tokens: scopes of hidden names, bracket groups, several inserts, odd rows."""

import pytest

from millrace.operators import scopes

CASES = {
    "insert into o select * from a, b x, c as y left join d on a.k = d.k, e where a.k in (1, 2)": {"a", "b", "c", "d", "e"},
    "insert into o select extract(year from q), substring(s from 2), f(x, y) from a": {"a"},
    "insert into o select coalesce((select max(k) from a), 0) from explode(z), b": {"a", "b"},
    "insert into o select * from (a join (select * from b) s on a.k = s.k)": {"a", "b"},
    "insert into o with t as (select * from t) select * from t": {"t"},
    "insert into o with t as (select 1), u as (select * from t) select * from u join T": set(),
    "with recursive t as (select * from a union all select * from t) insert into o select * from t": {"a"},
    "insert into o select * from t join (with t as (select * from a) select * from t) s": {"t", "a"},
    "insert into o select * from (with t as (select * from a) select * from t) s, t": {"t", "a"},
    "insert into o select * from a lateral view explode(a.x) v as p, q": {"a"},
    "insert into o select * from a where x is not distinct from y": {"a"},
    "create or replace temporary table o as select 'from z' from a -- from z": {"a"},
    "create table if not exists o as (select * from a) union all (select * from b)": {"a", "b"},
    "insert overwrite table o partition (d, h) select a, b from db.a": {"db.a"},
    "select * from a": set(),
    "drop table if exists o": set(),
    ")) from ((": set(),
}


@pytest.mark.parametrize("shuffled", [False, True])
def test_sources_by_scope(spark, shuffled):
    rows = [(str(i), sql) for i, sql in enumerate(CASES)]
    df = spark.createDataFrame(rows, "script_id string, sql string")
    got = scopes.scoped_edges(df.repartition(5) if shuffled else df).collect()
    found = {}
    for r in got:
        assert r.output_table == "o"
        found.setdefault(r.script_id, set()).add(r.input_table)
    assert {sql: found.get(str(i), set()) for i, sql in enumerate(CASES)} == CASES


def test_inserts_that_share_a_source_and_odd_rows(spark):
    multi = "from s insert into a select * from x insert overwrite table b select * where k in (select k from y); insert into c select * from z"
    rows = [("m", multi, 1), ("m", multi, 2), (None, "insert into n select * from v", 1), ("m", "insert into d select * from w", 1), ("e", None, 1), ("e", "", 1)]
    df = spark.createDataFrame(rows, "script_id string, sql string, group int")
    got = sorted((tuple(r) for r in scopes.scoped_edges(df).collect()), key=repr)
    expected = [("m", 0, "s", "a"), ("m", 0, "x", "a"), ("m", 0, "s", "b"), ("m", 0, "y", "b"), ("m", 1, "z", "c"), ("m", 0, "w", "d"), (None, 0, "v", "n")]
    assert got == sorted(expected, key=repr)
    assert scopes.scoped_edges(df.where("false")).count() == 0


def test_only_edges_are_shuffled(spark):
    """Tokens and statements stay where they are read, whatever the number of tokens."""
    rows = [(str(i), f"insert into o{i} with t as (select * from a) select * from t join (b join c{i} on f(x) = 1)") for i in range(50)]
    edges = scopes.scoped_edges(spark.createDataFrame(rows, "script_id string, sql string"))
    plan = edges._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan and "Join" not in plan
    got = {tuple(r) for r in edges.collect()}
    assert got == {(str(i), 0, source, f"o{i}") for i in range(50) for source in ("a", "b", f"c{i}")}


def test_statements_of_one_batch_stay_apart(spark):
    """Brackets, clauses and names that one statement leaves open mean nothing to the next; blank ones have no tokens."""
    texts = list(CASES) + ["insert into o select * from ((", "a, b", "with recursive t as (", "t as (select 1) insert into o select * from t", " ; ", "into o select * from a"]
    df = spark.createDataFrame([(str(i), sql) for i, sql in enumerate(texts)], "script_id string, sql string")
    together = {tuple(r) for r in scopes.scoped_edges(df.coalesce(1)).collect()}
    apart = {tuple(r) for r in scopes.scoped_edges(df.repartition(len(texts), "script_id")).collect()}
    assert together == apart
    assert {r[2] for r in together if r[0] == str(len(CASES) + 3)} == {"t"}
