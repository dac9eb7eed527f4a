"""Every registered query against its SQL counterpart on the smallest test tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def test_every_query_has_sql():
    assert set(driver.QUERIES) == set(driver.ORACLE)


@pytest.mark.parametrize("name", list(driver.QUERIES))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    columns = sorted(df.columns)
    relation = duck.sql(driver.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    got = Counter(tuple(r[c] for c in columns) for r in df.collect())
    want = Counter(tuple(r[i] for i in order) for r in relation.fetchall())
    assert got == want and got


def test_entry(spark):
    assert driver.entry(spark).count() > 0
