"""Every registered query against its SQL twin, on the smallest tables."""

import math
import pathlib

import duckdb
import pytest

import __spark_entry__ as contract

# the corpus operators have tests of their own
QUERIES = {k: v for k, v in contract.queries().items() if k not in contract.LLM_QUERIES}
ORACLES = {k: v for k, v in contract.oracle_sql().items() if k not in contract.LLM_QUERIES}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for file in pathlib.Path(sf).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(_value(r[i])) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert _canonical(df.columns, df.collect()) == _canonical(columns, cursor.fetchall())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
