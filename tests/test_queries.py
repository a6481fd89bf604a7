"""Every registered query against its SQL on the smallest given tables."""

import os
from datetime import datetime
from decimal import Decimal

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from pagelake.plans import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize())
    if isinstance(value, datetime):
        return value.isoformat()
    return f"{type(value).__name__}:{value!r}"


def ordered(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in places) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = queries()[name](spark, SF_DIR)
    got = ordered(df.columns, df.collect())
    result = db.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == ordered(columns, result.fetchall())


def test_entry(spark):
    assert entry(spark).columns == ["invoice_id", "n_lines", "revenue"]


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())
