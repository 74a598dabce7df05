"""Every registered query against its DuckDB oracle on sf0.001 (the driver does sf0.01)."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

from conftest import SF

import __spark_entry__ as E
from factline.plans.catalog import all_oracle_sql, all_queries

TABLES = "region nation customer supplier part orders lineitem events".split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "o_orderkey" in df.columns


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, con, name):
    df = all_queries()[name](spark, SF)
    got = sorted((tuple(norm(x) for x in r) for r in df.collect()), key=repr)
    rel = con.sql(all_oracle_sql()[name])
    idx = [rel.columns.index(c) for c in df.columns]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want
