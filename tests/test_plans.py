"""Plan shape: the physical plans the design promises, checked on the fixture mapping."""

from __future__ import annotations

import re

import pytest

from pyspark.sql import functions as F

from edflux.plans.queries import QUERIES
from edflux.sources.io import read_editions, write

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rollup_plan(spark):
    return plan(QUERIES["rollup_full"](spark, SF))


def test_no_expand_cartesian_or_python(rollup_plan):
    for bad in ("Expand", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in rollup_plan, bad


def test_aggregations_are_hash_based(rollup_plan):
    assert "SortAggregate" not in rollup_plan
    assert "HashAggregate" in rollup_plan


def test_edition_tables_are_broadcast(rollup_plan):
    # Enrichment, bucketed windows and the final window expansion are broadcast joins.
    assert rollup_plan.count("BroadcastHashJoin") >= 3


def test_own_history_has_no_range_join(spark):
    p = plan(QUERIES["own_history"](spark, SF))
    assert "Expand" not in p and "NestedLoop" not in p and "Cartesian" not in p


def test_recent_cut_is_pushed_to_the_edition_scan(spark, scratch_dir):
    from edflux.operators.prepare import editions_recent
    from edflux.sources.fixtures import FIXTURE_AS_OF, fixture_editions

    path = f"{scratch_dir}/sorteo"
    write(fixture_editions(spark, SF), path)
    recent = editions_recent(read_editions(spark, path), FIXTURE_AS_OF, dedup=False)
    text = recent._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(fecha_fin), LessThan(fecha_fin" in text
    assert "GreaterThan(fecha_fin" in text


def test_projection_is_pruned_at_the_fact_scan(spark):
    p = plan(QUERIES["own_history"](spark, SF))
    scans = [line for line in p.splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert scans
    for line in scans:
        read = line.split("ReadSchema: ")[1]
        assert "l_extendedprice" not in read and "l_comment" not in read


def test_recent_editions_prune_a_purchase_table_laid_out_by_edition(spark, scratch_dir):
    from edflux.operators.prepare import purchases_recent
    from edflux.plans.rollup import SwitchingAnalysis
    from edflux.sources.fixtures import FIXTURE_AS_OF, fixture_editions, fixture_purchases
    from edflux.sources.io import read_purchases

    path = f"{scratch_dir}/detalle"
    write(fixture_purchases(spark, SF), path, partitionBy=["clave_edicion_producto"])
    a = SwitchingAnalysis(read_purchases(spark, path), fixture_editions(spark, SF), FIXTURE_AS_OF)
    recent = {r.clave_edicion_producto for r in a.recent.collect()}
    for df in (purchases_recent(a.purchases, a.recent), a.flagged):
        assert "dynamicpruning" in plan(df) and " In(" not in plan(df)
        read = df.select("clave_detalle_compra", F.input_file_name().alias("f"))
        rows = read.collect()
        assert rows and {int(r.f.split("clave_edicion_producto=")[1].split("/")[0]) for r in rows} <= recent


def test_flow_plan_has_no_expand(spark):
    p = plan(QUERIES["migration_flow"](spark, SF))
    assert "Expand" not in p and "Cartesian" not in p and "NestedLoop" not in p


def test_checkpointed_pairs_give_the_same_rollup(spark):
    from pyspark.sql import functions as F

    from edflux.plans.rollup import SwitchingAnalysis
    from edflux.sources.fixtures import FIXTURE_AS_OF, fixture_editions, fixture_purchases

    def run(ckpt):
        a = SwitchingAnalysis(
            fixture_purchases(spark, SF), fixture_editions(spark, SF), FIXTURE_AS_OF, checkpoint=ckpt
        )
        return sorted(tuple(r) for r in a.rollup.orderBy(F.col("clave_persona")).collect())

    assert run(True) == run(False)


def test_stages_of_the_rollup_are_short_enough_to_be_compiled(spark, capsys):
    # The JVM interprets methods of more than 8,000 bytes.
    df = QUERIES["rollup_full"](spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert len(sizes) > 10 and max(sizes) < 8000


def test_role_rows_are_shuffled_three_times_and_not_aggregated_in_the_scan(rollup_plan):
    assert rollup_plan.count("Exchange hashpartitioning(clave_persona") == 3
    scan = rollup_plan[rollup_plan.rindex("Exchange hashpartitioning(clave_persona") :]
    assert "HashAggregate(keys=[clave_persona" not in scan


def test_tolerant_rules_read_each_text_once_made(spark):
    # A rule that repeats the expression of its column makes a method too long to be compiled.
    assert plan(QUERIES["purchases_tolerant"](spark, SF)).count("99999999999999999999") == 1


@pytest.mark.parametrize(
    "name",
    ["class_summary", "migration_flow", "migration_flow_stored", "other_purchases"]
    + ["rollup_date_nulls", "rollup_full", "rollup_recurrent", "rollup_recurrent_min1"],
)
def test_tickets_need_no_map_in_the_scan_of_any_query(spark, name):
    # A map of tickets there grows with a scan's split, which adaptive execution doesn't bound.
    p = plan(QUERIES[name](spark, SF))
    scan = p[p.rindex("Exchange hashpartitioning(clave_persona") :]
    assert "numero_boleto" in scan and "lineitem" in scan
    assert "HashAggregate(keys=[clave_persona" not in scan
