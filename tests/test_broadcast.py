"""Broadcast bounds: rows and bytes, at their edges, and the same join beyond them."""

import pytest

from edflux.plans.broadcast import bounded_broadcast, is_bounded

def plan_text(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


ROWS = [(1, "é" * 10), (2, None), (3, "")]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(ROWS, "k long, `a text` string")


def test_rows_and_bytes_both_bound(small):
    size = 3 * 2 * 8 + 20  # eight a column, and ten letters of two bytes
    assert is_bounded(small, 3, size) and not is_bounded(small, 2, size) and not is_bounded(small, 3, size - 1)


def test_empty_tables_are_bounded(small):
    assert is_bounded(small.limit(0), 0, 0)


def test_a_table_of_long_texts_is_joined_without_a_hint(spark, small):
    big = spark.range(5).withColumnRenamed("id", "k")
    hinted, plain = (big.join(bounded_broadcast(small, 10, most), "k") for most in (1_000, 60))
    assert "strategy=broadcast" in plan_text(hinted) and "strategy=broadcast" not in plan_text(plain)
    assert sorted(map(str, hinted.collect())) == sorted(map(str, plain.collect())) and hinted.count() == 3
