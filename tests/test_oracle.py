"""Every registered query against its SQL on the same tables."""

import decimal
import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from tests.conftest import DATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
FOLDER = os.environ.get("TEST_SF_DIR", f"{DATA}/sf0.001")
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def table(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    mine = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    theirs = table(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert len(df.columns) == len(set(df.columns))
    assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_gives_one_row_per_model(spark):
    assert entry_points.entry(spark).count() == 4
