"""Queries with a SQL twin, on the smallest tables."""

import pytest

from millrace.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    key = lambda rows: sorted((tuple(map(repr, r)) for r in rows))
    assert key(df.select(*columns).collect()) == key(cursor.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
