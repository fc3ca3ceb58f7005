"""Every registered query against its DuckDB oracle SQL on sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

from shelfwise.plans.oracle import ORACLE_SQL
from shelfwise.plans.queries import QUERIES

NAMES = sorted(QUERIES)


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else round(v, 6)
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF001):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF001}/{f}')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = df.collect()
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, got) == _canon(ocols, res.fetchall())


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["seller_id", "item_id", "item_name", "category", "market_price",
                          "expected_units_sold", "expected_revenue"]
    assert df.count() == 12
