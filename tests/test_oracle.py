"""Every registered query against its DuckDB oracle on sf0.001, and the
driver's smoke entry."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E
from playtrail.plans.catalog import QUERIES

from .conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    return v


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{Path(SF_SMALL) / 'events.parquet'}')")
    return con


SQL = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    assert name in SQL
    res = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _bag(rows, df.columns) == _bag(res.fetchall(), res.columns)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "account_id"


@pytest.mark.parametrize("name", ["local_days", "attribution_r3", "attribution_r4_hot_keys"])
def test_results_do_not_depend_on_the_session_time_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    res = duck.sql(SQL[name])
    assert _bag(rows, df.columns) == _bag(res.fetchall(), res.columns)
