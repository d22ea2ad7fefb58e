"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lectern.plans import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else v.isoformat() if hasattr(v, "isoformat") else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    if name in SQL:
        r = duck.sql(SQL[name])
        assert sorted(r.columns) == sorted(df.columns)
        assert got == sorted(tuple(plain(x[r.columns.index(c)]) for c in sorted(r.columns)) for x in r.fetchall())
    else:
        assert got


def test_contract(spark):
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert entry.entry(spark).columns == ["source", "clips", "missing", "stale", "done", "chars"]
