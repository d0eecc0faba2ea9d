"""What results leave on disk: shuffle files go with their write, and the shuffles carry no more than they must."""

from __future__ import annotations

import glob
import os
import re
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from edflux.plans.queries import QUERIES
from edflux.plans.rollup import SwitchingAnalysis
from edflux.session import ensure_checkpoint_dir
from edflux.sources import publish
from edflux.sources.fixtures import FIXTURE_AS_OF, fixture_editions, fixture_purchases
from edflux.sources.io import read_snapshot, write

SF = "/root/testdata/sf0.001"


def shuffle_files(spark) -> set[str]:
    return set(glob.glob(f"{spark.conf.get('spark.local.dir')}/**/shuffle_*.data", recursive=True))


def left_over(spark, before: set[str]) -> set[str]:
    """New shuffle files that are there when they had time to be removed (Spark doesn't wait for it)."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    return shuffle_files(spark) - before


@pytest.fixture()
def summed(spark):
    """Rows that come from a shuffle of their own."""
    return spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))


@pytest.mark.parametrize("fmt", ["parquet", "csv", "table"])
def test_a_write_leaves_no_shuffle_files(spark, summed, scratch_dir, fmt):
    before = shuffle_files(spark)
    write(summed, "summed_once" if fmt == "table" else f"{scratch_dir}/out", fmt)
    assert not left_over(spark, before)
    for day in ("2024-06-01", "2024-06-08")[: 1 if fmt == "table" else 2]:  # a later day of a table is a SQL INSERT
        publish.write_snapshot(summed, "summed_by_day" if fmt == "table" else f"{scratch_dir}/dated", day, fmt)
        assert not left_over(spark, before)


@pytest.mark.parametrize("held", [None, "false", "true"])
def test_the_setting_is_put_back(spark, held):
    spark.conf.set(publish.SHUFFLE_CLEANUP, held) if held else spark.conf.unset(publish.SHUFFLE_CLEANUP)
    try:
        with pytest.raises(ValueError), publish.shuffles_released(spark):
            assert spark.conf.get(publish.SHUFFLE_CLEANUP) == "true"
            raise ValueError
        assert spark.conf.get(publish.SHUFFLE_CLEANUP, None) == held
    finally:
        spark.conf.unset(publish.SHUFFLE_CLEANUP)


def test_rows_stored_for_now_go_with_the_block(spark, summed, scratch_dir):
    want, before = sorted(summed.collect()), shuffle_files(spark)
    with publish.stored_for_now(summed, f"{scratch_dir}/rows") as rows:
        assert rows.schema == summed.schema and sorted(rows.collect()) == want
    assert os.listdir(scratch_dir) == [] and not left_over(spark, before)
    with pytest.raises(ValueError), publish.stored_for_now(summed, f"{scratch_dir}/rows"):
        raise ValueError
    assert os.listdir(scratch_dir) == []
    with pytest.raises(Exception, match="broken row"), publish.stored_for_now(summed.select(F.raise_error(F.lit("broken row")).cast("long").alias("k")), f"{scratch_dir}/rows"):
        pass
    assert os.listdir(scratch_dir) == []


def test_snapshots_leave_themselves_alone_and_packed(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    places, before = set(glob.glob(f"{folder}/snapshots-*")), shuffle_files(spark)
    got = QUERIES["rollup_snapshot"](spark, SF)
    assert not glob.glob(f"{folder}/detalle-*/*.parquet")
    [place] = set(glob.glob(f"{folder}/snapshots-*")) - places
    files = glob.glob(f"{place}/*/*.parquet")
    assert {os.path.basename(os.path.dirname(f)) for f in files} == {"fecha_corte=2000-08-02", "fecha_corte=2001-08-02"}
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    left = left_over(spark, before)
    assert len(left) < 10, left  # edition-sized jobs (windows and size checks) aren't writes; two rollups leave over 20
    want = SwitchingAnalysis(fixture_purchases(spark, SF), fixture_editions(spark, SF), FIXTURE_AS_OF).rollup
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    earlier = SwitchingAnalysis(fixture_purchases(spark, SF), fixture_editions(spark, SF), "2000-08-02 12:00:00").rollup
    assert sorted(read_snapshot(spark, f"file:{place}", "2001-08-01").collect(), key=str) == sorted(earlier.collect(), key=str)


def test_role_rows_and_pairs_are_shuffled_without_what_can_be_added_later(spark):
    a = SwitchingAnalysis(fixture_purchases(spark, SF), fixture_editions(spark, SF), FIXTURE_AS_OF)
    plan = a.rollup._jdf.queryExecution().executedPlan().toString()
    sent = [m for m in re.findall(r"Exchange hashpartitioning\(clave_persona.*\n.*", plan)]
    assert len(sent) == 3 and not any("fecha_fin" in s for s in sent) and "min_by(fecha_fin" not in plan
    assert "json" not in a.core.pairs.schema["od"].dataType.elementType.names


def test_part_keys_are_not_shuffled_to_the_orders(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixture_purchases(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    [sent] = re.findall(r"Exchange hashpartitioning\(l_orderkey.*\n.*", plan)
    assert "l_suppkey" in sent and "l_partkey" not in sent
