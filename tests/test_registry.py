"""Every registered query beside its SQL, on the smallest given tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = Path("/root/testdata/sf0.001")
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def ordered(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in at], sorted(([str(r[i]) for i in at] for r in rows))


@pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")
@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, db, name):
    df = registry.queries()[name](spark, str(SF_DIR))
    got = ordered(df.columns, df.collect())
    assert got[1]
    statement = registry.oracle_sql().get(name)
    if statement:
        cursor = db.execute(statement)
        want = ordered([d[0] for d in cursor.description], cursor.fetchall())
        assert got[0] == want[0]
        assert len(got[1]) == len(want[1])
        assert got[1] == want[1]


def test_oracle_names_are_queries():
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")
def test_entry(spark):
    assert registry.entry(spark).columns == ["intent", "escalate", "n"]
