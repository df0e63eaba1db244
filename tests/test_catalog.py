"""Every catalog query against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n in entry_module.queries() if n in entry_module.oracle_sql()])
def test_query_agrees(spark, duck, name):
    df = entry_module.queries()[name](spark, FOLDER)
    other = duck.sql(entry_module.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(other.columns)
    types = dict(zip(other.columns, map(str, other.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    places = [other.columns.index(c) for c in columns]
    mine = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    theirs = sorted((tuple(r[p] for p in places) for r in other.fetchall()), key=repr)
    assert mine == theirs


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
