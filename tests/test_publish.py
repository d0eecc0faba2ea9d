"""Replacing results, dated snapshots, and pruning of the fact scan by the recent editions' keys."""

from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edflux.operators.prepare import purchases_recent
from edflux.plans import pruning
from edflux.plans.rollup import SwitchingAnalysis, recurrent, rollup
from edflux.schemas import ROLLUP
from edflux.sources import publish
from edflux.sources.fixtures import FIXTURE_AS_OF, fixture_editions, fixture_purchases
from edflux.sources.io import read_purchases, read_rollup, read_snapshot, typed_rollup, write
from tests.helpers import editions_df, purchases_df
from tests.test_io_flow import AS_OF, EDS, PS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark):
    return rollup(purchases_df(spark, PS), editions_df(spark, EDS), AS_OF)


def failing(df):
    """Rows of which some can be written before one fails."""
    return df.repartition(4).withColumn("hist_boletos_pre_cierre", F.when(F.col("clave_persona") < 2, F.col("hist_boletos_pre_cierre")).otherwise(F.raise_error(F.lit("broken row")).cast("long")))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_failed_job_leaves_the_old_files(spark, result, scratch_dir, fmt):
    place = f"{scratch_dir}/out"
    write(result, place, fmt)
    before = sorted(os.listdir(place))
    with pytest.raises(Exception, match="broken row"):
        write(failing(result), place, fmt)
    assert sorted(os.listdir(place)) == before and os.listdir(scratch_dir) == ["out"]
    assert sorted(read_rollup(spark, place, fmt).collect()) == sorted(result.collect())
    write(result.limit(1), place, fmt)
    assert read_rollup(spark, place, fmt).count() == 1 and os.listdir(scratch_dir) == ["out"]


def test_a_failed_job_leaves_the_old_table(spark, result):
    write(result, "kept_rollup", "table")
    with pytest.raises(Exception, match="broken row"):
        write(failing(result), "kept_rollup", "table")
    assert sorted(read_rollup(spark, "kept_rollup", "table").collect()) == sorted(result.collect())
    write(result.limit(1), "kept_rollup", "table")
    assert spark.table("kept_rollup").count() == 1
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("kept_rollup")] == ["kept_rollup"]


def test_a_failed_swap_puts_the_old_files_back(spark, scratch_dir):
    place = f"{scratch_dir}/out"
    write(spark.range(3), place)
    fs, path = publish._fs(spark, place)
    with pytest.raises(Exception, match="missing"):
        publish._swap(fs, path(place), path(f"{scratch_dir}/missing"), path(f"{scratch_dir}/old"))
    assert spark.read.parquet(place).count() == 3 and os.listdir(scratch_dir) == ["out"]


def test_a_result_may_replace_its_own_input(spark, result, scratch_dir):
    place = f"{scratch_dir}/out"
    write(result, place)
    want = recurrent(result, 1).count()
    write(recurrent(read_rollup(spark, place), 1), place)
    assert read_rollup(spark, place).count() == want < result.count()


@pytest.mark.parametrize("fmt", ["parquet", "csv", "table"])
def test_snapshots_by_day(spark, result, scratch_dir, fmt):
    place = "dated_rollup" if fmt == "table" else f"{scratch_dir}/dated"
    first, second = result.where("clave_persona = 1"), result.where("clave_persona = 2")
    publish.write_snapshot(first, place, "2024-06-01", fmt)
    publish.write_snapshot(result, place, date(2024, 6, 8), fmt)
    publish.write_snapshot(second, place, "2024-06-01", fmt)  # a day again, alone
    assert publish.snapshot_days(spark, place, fmt) == [date(2024, 6, 1), date(2024, 6, 8)]
    for as_of, want in ((None, result), ("2024-06-07", second), ("2024-06-08", result)):
        got = read_snapshot(spark, place, as_of, fmt)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in ROLLUP]
        assert sorted(got.collect()) == sorted(want.collect())
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, place, "2024-05-31", fmt)
    if fmt == "parquet":
        plan = read_snapshot(spark, place, "2024-06-07")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(fecha_corte" in plan


def test_a_failed_snapshot_leaves_the_day(spark, result, scratch_dir):
    place = f"{scratch_dir}/dated"
    publish.write_snapshot(result, place, "2024-06-01")
    with pytest.raises(Exception, match="broken row"):
        publish.write_snapshot(failing(result), place, "2024-06-01")
    assert sorted(read_snapshot(spark, place).collect()) == sorted(result.collect())


def test_stored_types_are_made_the_rollups(spark, result):
    other = result.select(*(F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name).cast("string" if isinstance(f.dataType, T.LongType) else f.dataType).alias(f.name) for f in ROLLUP))
    got = typed_rollup(other)
    assert [f.dataType for f in got.schema] == [f.dataType for f in ROLLUP]
    assert sorted(got.collect()) == sorted(result.collect())


# ------------------------------------------------------------------ pruning by keys


def test_ranges_cover_the_keys_and_split_at_gaps():
    assert pruning.widest_gaps([]) == ()
    assert pruning.widest_gaps([5]) == ((5, 5),)
    assert pruning.widest_gaps([1, 2, 3, 10, 11, 50], 3) == ((1, 3), (10, 11), (50, 50))
    assert pruning.widest_gaps([1, 2, 3, 10, 11, 50], 2) == ((1, 11), (50, 50))
    assert pruning.widest_gaps([1, 2, 3, 4], 3) == ((1, 4),)


def test_bitmap_keeps_all_keys_and_drops_most_others(spark):
    small = spark.range(0, 4000, 2).withColumnRenamed("id", "k")
    big = spark.range(-1000, 9000).withColumnRenamed("id", "k").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k"))
    got = {r.k for r in pruning.in_bitmap(big, pruning.key_bitmap(small, "k", 1 << 17), "k", 1 << 17).collect()}
    keys = set(range(0, 4000, 2))
    assert keys <= got and len(got - keys) < 400 and None not in got
    near = {r.k for r in pruning.near_keys(big, small, "k", max_keys=10, bits=1 << 17).collect()}
    assert keys <= near <= got | keys and max(near) <= 3998
    assert pruning.near_keys(big, small.where("k < 0"), "k").count() == 0


def test_recent_keys_drop_row_groups_of_an_unpartitioned_table(spark, scratch_dir):
    path = f"{scratch_dir}/detalle"
    facts = fixture_purchases(spark, SF).repartition(1).sortWithinPartitions("clave_edicion_producto")
    facts.write.option("parquet.block.size", 4096).option("parquet.page.row.count.limit", 200).parquet(path)
    a = SwitchingAnalysis(read_purchases(spark, path), fixture_editions(spark, SF), FIXTURE_AS_OF)
    recent = a.recent.select("clave_edicion_producto")
    want = sorted(r.clave_detalle_compra for r in fixture_purchases(spark, SF).join(recent, "clave_edicion_producto").collect())
    df = purchases_recent(a.purchases, a.recent)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(clave_edicion_producto" in text.split("PushedFilters: ")[1]
    assert "GreaterThanOrEqual(clave_edicion_producto" in a.flagged._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.clave_detalle_compra for r in df.collect()) == want
    # without the ranges every row leaves the scan; with them only row groups that overlap
    ranges = pruning.key_ranges(a.recent, "clave_edicion_producto")
    assert ranges.exact and 1 < len(ranges.ranges) <= pruning.MAX_RANGES
    scan = spark.read.parquet(path).where(ranges.test(F.col("clave_edicion_producto")))
    kept = scan.collect()
    plan = scan._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    read = leaf.metrics().apply("numOutputRows").value()
    assert len(want) <= len(kept) <= read < facts.count()


def test_pruning_beyond_the_key_bound_gives_the_same_rows(spark, monkeypatch):
    a = SwitchingAnalysis(fixture_purchases(spark, SF), fixture_editions(spark, SF), FIXTURE_AS_OF)
    want = sorted(purchases_recent(a.purchases, a.recent).collect(), key=str)
    monkeypatch.setattr(pruning.key_ranges, "__defaults__", (5, 16))
    monkeypatch.setattr(pruning.near_keys, "__defaults__", (5, 1 << 16))
    assert sorted(purchases_recent(a.purchases, a.recent).collect(), key=str) == want
    empty = SwitchingAnalysis(fixture_purchases(spark, SF), fixture_editions(spark, SF), datetime(1980, 1, 1))
    assert empty.rollup.collect() == []
