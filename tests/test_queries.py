"""Every registered query that SQL can state against its SQL on the smallest tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry_points

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def database():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_agrees_with_its_sql(name, spark, database):
    found = entry_points.queries()[name](spark, DATA)
    columns = sorted(found.columns)
    rows = [tuple(comparable(r[c]) for c in columns) for r in found.collect()]
    assert rows, "a query that finds nothing checks nothing"
    answer = database.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    expected = [tuple(comparable(r[names.index(c)]) for c in columns) for r in answer.fetchall()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    found = entry_points.entry(spark)
    assert found.count() > 0 and found.columns[0] == "site"
