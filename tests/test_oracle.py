"""Every registered query against its SQL, on the given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import TESTDATA
from prflow.queries import ORACLE_SQL, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    df = entry.queries()[name](spark, TESTDATA)
    columns = sorted(df.columns)
    result = oracle.execute(entry.oracle_sql()[name])
    described = {c[0]: str(c[1]) for c in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == described
    order = [list(described).index(c) for c in columns]
    wanted = sorted(repr(tuple(r[i] for i in order)) for r in result.fetchall())
    got = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    assert got == wanted


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
