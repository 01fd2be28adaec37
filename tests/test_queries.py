"""Every query with SQL against DuckDB, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return "null" if value is None else str(value)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    result = entry.queries()[name](spark, FOLDER)
    columns = sorted(result.columns)
    rows = sorted(tuple(plain(x) for x in r) for r in result.select(*columns).collect())
    expected = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == sorted(tuple(plain(r[i]) for i in order) for r in expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
