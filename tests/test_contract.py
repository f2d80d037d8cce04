"""The driver's contract at the smallest size: every query runs, and agrees with its SQL."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from claimspark import plans

QUERIES, SQL = plans.queries(), plans.oracle_sql()


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    rows = df.collect()
    if name in SQL:
        cur = con.execute(SQL[name])
        columns = [c[0] for c in cur.description]
        assert sorted(columns) == sorted(df.columns)
        order = sorted(columns)
        want = sorted((tuple(norm(r[columns.index(c)]) for c in order) for r in cur.fetchall()), key=repr)
        assert sorted((tuple(norm(r[c]) for c in order) for r in rows), key=repr) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
