"""Every registered query against its SQL, on whole tables."""

import math
import os
from collections import Counter
from datetime import datetime

import duckdb
import pytest

from __spark_entry__ import _QUERIES, _SQL, entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
         "float": "FLOAT", "date": "DATE", "timestamp": "TIMESTAMP",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert {c: KINDS[t] for c, t in df.dtypes} == kinds
    actual = df.collect()
    assert len(actual) > 0
    assert len(actual) == len(expected)
    assert _bag(df.columns, actual) == _bag(names, expected)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(_SQL) == set(_QUERIES)
    assert set(oracle_sql()) <= set(queries())
