"""The driver contract: entry(), queries() and oracle_sql() agree on sf0.001."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.verify_oracle import _digest

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) == 21


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(want)
    assert _digest(df.columns, rows) == _digest(cols, want)


@pytest.mark.parametrize("name", ["purchase_dates_parsed", "rollup_full"])
def test_results_do_not_depend_on_the_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = entry.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert _digest(df.columns, rows) == _digest(cols, res.fetchall())
