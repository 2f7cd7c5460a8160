"""Every registered query against its SQL on DuckDB. ``SF`` picks the scale."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from lakeweave.catalog import ORACLES, QUERIES

FOLDER = f"/root/testdata/sf{os.environ.get('SF', '0.001')}"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    return con


def plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted([tuple(plain(v) for v in r) for r in df.select([f"`{c}`" for c in columns]).collect()], key=repr)
    answer = duck.sql(ORACLES[name])
    assert sorted(answer.columns) == columns
    order = [answer.columns.index(c) for c in columns]
    expected = sorted([tuple(plain(r[i]) for i in order) for r in answer.fetchall()], key=repr)
    assert got == expected


def test_entry_runs(spark):
    df = driver.entry(spark)
    assert df.columns == ["DateKey", "HourOfDay", "pickup_zone", "totaltrips", "totalrevenue"]
    assert 0 < df.count() <= 100


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(driver.oracle_sql()) <= set(driver.queries()) and set(QUERIES) <= set(driver.queries())
