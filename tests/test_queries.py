"""Every registered query against its SQL twin on the smallest tables."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver

QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return f"{float(value):.12g}"
    if isinstance(value, datetime.datetime):
        return str(value.replace(tzinfo=None))
    return value


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    expected = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(expected.columns, expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_without_sql_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) > 10 and sum(r.keywords for r in rows) > 1000
