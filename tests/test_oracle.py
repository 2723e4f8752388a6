"""Every named query against an independent engine on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

from factgrade.catalogue import cases, learned, oracle, queries

QUERIES = queries.QUERIES | cases.QUERIES | learned.QUERIES
ORACLE = oracle.ORACLE | cases.ORACLE | learned.ORACLE


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for name in os.listdir(sf):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf}/{name}'")
    return con


def canonical(rows):
    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted(
        (tuple(value(v) for v in r) for r in rows), key=lambda r: [(v is None, type(v).__name__, str(v)) for v in r]
    )


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    columns = sorted(df.columns)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = canonical([[r[i] for i in order] for r in result.fetchall()])
    got = canonical([[r[c] for c in columns] for r in df.collect()])
    assert len(got) == len(expected)
    assert got == expected


def test_entry(spark, sf):
    df = entry.entry(spark)
    assert df.columns[0] == "lang"
    assert df.count() > 0
