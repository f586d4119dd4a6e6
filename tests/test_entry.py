"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from pagemill.plans.oracle import ORACLE
from pagemill.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
SQL = driver.oracle_sql()
QUERIES = {name: driver.queries()[name] for name in REGISTRY}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def comparable(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return repr(value)
    return repr(float(value))


def test_every_query_has_sql():
    assert REGISTRY.keys() == ORACLE.keys()
    assert REGISTRY.keys() <= driver.queries().keys()
    assert ORACLE.keys() <= SQL.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, tables, name):
    frame = QUERIES[name](spark, SF)
    names = sorted(frame.columns)
    found = sorted(tuple(comparable(row[c]) for c in names) for row in frame.collect())
    result = tables.execute(SQL[name])
    given = [d[0] for d in result.description]
    assert sorted(given) == names
    order = [given.index(c) for c in names]
    assert found == sorted(tuple(comparable(row[i]) for i in order) for row in result.fetchall())


def test_flagship(spark):
    rows = driver.entry(spark).collect()
    assert rows and sum(r["n"] for r in rows) > 0
