"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check import TABLES, rows_of
from tributary.plans.registry import QUERIES as REGISTERED

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: query.build for name, query in REGISTERED.items()}
ORACLE = {name: query.sql for name, query in REGISTERED.items() if query.sql}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLE) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, FOLDER)
    relation = db.sql(ORACLE[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    assert got == rows_of(relation.columns, relation.fetchall())


def test_entry(spark):
    frame = spark_entry.entry(spark)
    assert frame.columns == ["type", "n"] and frame.count() == 5
