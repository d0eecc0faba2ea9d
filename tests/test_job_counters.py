"""Quality counters gathered by the rollup's own job."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from edflux.cli import main
from edflux.operators.quality import JobCounters, quality_counters
from edflux.plans.rollup import SwitchingAnalysis
from edflux.sources.fixtures import FIXTURE_AS_OF, fixture_editions, fixture_purchases
from edflux.sources.io import write
from tests.helpers import d, edition, editions_df, purchase, purchases_df
from tests.test_io_flow import AS_OF, EDS, PS

SF = "/root/testdata/sf0.001"
ODD = [*PS, purchase(None, 1, d("2024-05-29"), 91), purchase(2, 1, None, 92), purchase(3, 777, d("2024-05-29"), 93)]


def values(df):
    return {r["metric"]: r["value"] for r in df.collect()}


def both(purchases, editions, as_of, checkpoint=False):
    a = SwitchingAnalysis(purchases, editions, as_of, checkpoint=checkpoint, counters=JobCounters())
    rows = a.rollup.collect()
    plain = SwitchingAnalysis(purchases, editions, as_of)
    assert sorted(map(str, rows)) == sorted(map(str, plain.rollup.collect()))
    got = a.counters.table(a.purchases, a.editions, a.recent, a.windows)
    want = quality_counters(purchases, editions, plain.recent, plain.windows)
    assert got.schema.simpleString() == want.schema.simpleString()
    return values(got), values(want)


@pytest.mark.parametrize("checkpoint", [False, True])
def test_counters_of_the_job_equal_their_own_pass(spark, checkpoint):
    got, want = both(purchases_df(spark, ODD), editions_df(spark, EDS), AS_OF, checkpoint)
    assert got == want and got["compras"] == len(ODD) and got["compras_sin_fecha"] == 1


def test_counters_of_the_given_tables(spark):
    got, want = both(fixture_purchases(spark, SF), fixture_editions(spark, SF), FIXTURE_AS_OF)
    assert got == want and got["grupos_persona_producto"] > 0


def test_counters_without_recent_editions_or_purchases(spark):
    old = [edition(1, 1, 1, datetime(1999, 5, 1), datetime(1999, 5, 31))]
    got, want = both(purchases_df(spark, ODD), editions_df(spark, old), AS_OF)
    assert got == want and got["compras"] == len(ODD) and got["compras_recientes"] == 0
    got, want = both(purchases_df(spark, []), editions_df(spark, EDS), AS_OF)
    assert got == want and got["compras"] == 0


def test_the_command_writes_them_without_another_scan_of_the_purchases(spark, scratch_dir):
    write(purchases_df(spark, ODD), f"{scratch_dir}/p")
    write(editions_df(spark, EDS), f"{scratch_dir}/e")
    args = ["rollup", "--purchases", f"{scratch_dir}/p", "--editions", f"{scratch_dir}/e", "--as-of", str(AS_OF)]
    assert main([*args, "--out", f"{scratch_dir}/r", "--metrics-out", f"{scratch_dir}/m", "--metrics-out-format", "csv"]) == 0
    written = {r["metric"]: int(r["value"]) for r in spark.read.csv(f"{scratch_dir}/m", header=True).collect()}
    p, e = spark.read.parquet(f"{scratch_dir}/p"), editions_df(spark, EDS)
    a = SwitchingAnalysis(p, e, AS_OF, counters=JobCounters())
    a.rollup.write.format("noop").mode("overwrite").save()
    table = a.counters.table(p, e, a.recent, a.windows)
    assert written == values(table)
    plan = json.loads(table._jdf.queryExecution().optimizedPlan().toJSON())
    assert not any("clave_detalle_compra" in json.dumps(node.get("output", "")) for node in plan)
