"""Readers/writers round trips and the migration flow."""

from __future__ import annotations

import json
from datetime import datetime

from edflux.operators.flow import migration_flow
from edflux.plans.rollup import rollup
from edflux.schemas import ROLLUP_COLUMNS
from edflux.sources.io import read_editions, read_purchases, read_rollup, write
from tests.helpers import d, dicts, edition, editions_df, purchase, purchases_df

AS_OF = datetime(2024, 6, 15, 12)
EDS = [
    edition(104, 1, 5, datetime(2024, 4, 1), datetime(2024, 4, 30)),
    edition(105, 1, 6, datetime(2024, 5, 1), datetime(2024, 5, 31)),
    edition(205, 2, 6, datetime(2024, 5, 1), datetime(2024, 5, 31)),
    edition(206, 2, 7, datetime(2024, 5, 20), datetime(2024, 6, 10)),
]
PS = [
    purchase(1, 104, d("2024-04-03"), 1),
    purchase(1, 205, d("2024-05-28"), 2),
    purchase(1, 206, d("2024-05-29"), 3),
    purchase(2, 104, d("2024-04-03"), 4),
    purchase(2, 205, d("2024-05-27"), 5),
]


def test_csv_and_parquet_roundtrip(spark, scratch_dir):
    ps, eds = purchases_df(spark, PS), editions_df(spark, EDS)
    for fmt in ("parquet", "csv"):
        write(ps, f"{scratch_dir}/p_{fmt}", fmt)
        write(eds, f"{scratch_dir}/e_{fmt}", fmt)
        assert sorted(read_purchases(spark, f"{scratch_dir}/p_{fmt}", fmt).collect()) == sorted(ps.collect())
        assert sorted(read_editions(spark, f"{scratch_dir}/e_{fmt}", fmt).collect()) == sorted(eds.collect())


def test_rollup_roundtrip_through_csv_and_table(spark, scratch_dir):
    r = rollup(purchases_df(spark, PS), editions_df(spark, EDS), AS_OF)
    write(r, f"{scratch_dir}/r_csv", "csv")
    back = read_rollup(spark, f"{scratch_dir}/r_csv", "csv")
    assert back.columns == ROLLUP_COLUMNS
    assert sorted(back.collect()) == sorted(r.collect())
    write(r, "rollup_snapshot", "table")
    assert sorted(read_rollup(spark, "rollup_snapshot", "table").collect()) == sorted(r.collect())


def test_migration_flow_counts_distinct_customers_per_edition_pair(spark):
    eds = editions_df(spark, EDS)
    r = rollup(purchases_df(spark, PS), eds, AS_OF)
    lost = [x for x in dicts(r) if x["canibalizacion_clase"] == "PERDIDO_A_OTRO_EN_CIERRE"]
    assert {x["clave_persona"] for x in lost} == {1, 2}
    flow = dicts(migration_flow(r, eds))
    got = {(f["producto_origen_tag"], f["producto_destino_tag"]): f["clientes_perdidos"] for f in flow}
    assert got == {("S1 6", "S2 6"): 2, ("S1 6", "S2 7"): 1}


def test_migration_flow_missing_destination_and_empty_lists(spark):
    r = rollup(purchases_df(spark, PS), editions_df(spark, EDS), AS_OF)
    # Tag dimension without edition 206: its flow row keeps a null tag.
    flow = dicts(migration_flow(r, editions_df(spark, EDS[:3])))
    missing = [f for f in flow if f["producto_destino_id"] == 206]
    assert missing and missing[0]["producto_destino_tag"] is None
    # Rows whose detail list is empty produce no flow rows.
    assert all(json.loads(x["otros_detalle_en_ventana_ultima_json"]) for x in dicts(r) if x["canibalizacion_clase"].startswith("PERDIDO"))


def test_rollup_csv_dates_strict_or_lenient(spark, scratch_dir):
    import pytest
    from pyspark.sql import functions as F

    r = rollup(purchases_df(spark, PS), editions_df(spark, EDS), AS_OF)
    bad = r.withColumn("ultima_fecha_inicio", F.lit("2024-13-45"))
    write(bad, f"{scratch_dir}/bad", "csv")
    lenient = read_rollup(spark, f"{scratch_dir}/bad", "csv", lenient_dates=True)
    assert lenient.where(F.col("ultima_fecha_inicio").isNotNull()).count() == 0
    assert lenient.count() == r.count()
    with pytest.raises(Exception):
        read_rollup(spark, f"{scratch_dir}/bad", "csv").collect()


def test_command_line_jobs(spark, scratch_dir):
    from edflux.cli import main

    write(purchases_df(spark, PS), f"{scratch_dir}/p")
    write(editions_df(spark, EDS), f"{scratch_dir}/e", "csv")
    base = ["rollup", "--purchases", f"{scratch_dir}/p", "--editions", f"{scratch_dir}/e", "--editions-format", "csv"]
    assert main(base + ["--out", f"{scratch_dir}/r", "--out-format", "csv", "--as-of", "2024-06-15 12:00:00",
                        "--recurrent-out", f"{scratch_dir}/rr", "--min-editions", "1"]) == 0
    want = rollup(purchases_df(spark, PS), editions_df(spark, EDS), AS_OF)
    got = read_rollup(spark, f"{scratch_dir}/r", "csv")
    assert sorted(got.collect()) == sorted(want.collect())
    assert read_rollup(spark, f"{scratch_dir}/rr").count() == want.where("hist_ediciones_distintas >= 1").count()
    assert main(["--explain", "recurrent", "--rollup", f"{scratch_dir}/r", "--rollup-format", "csv",
                 "--out", f"{scratch_dir}/r2"]) == 0
    assert main(["flow", "--rollup", f"{scratch_dir}/r", "--rollup-format", "csv", "--editions", f"{scratch_dir}/e",
                 "--editions-format", "csv", "--out", f"{scratch_dir}/f"]) == 0
    flow = {(r["producto_origen_tag"], r["producto_destino_tag"]): r["clientes_perdidos"] for r in spark.read.parquet(f"{scratch_dir}/f").collect()}
    assert flow == {("S1 6", "S2 6"): 2, ("S1 6", "S2 7"): 1}
    assert main(["single-window", "--purchases", f"{scratch_dir}/p", "--editions", f"{scratch_dir}/e",
                 "--editions-format", "csv", "--out", f"{scratch_dir}/s"]) == 0
    assert spark.read.parquet(f"{scratch_dir}/s").count() > 0


def test_partitioned_rollup_output(spark, scratch_dir):
    import os

    from edflux.cli import main

    write(purchases_df(spark, PS), f"{scratch_dir}/p")
    write(editions_df(spark, EDS), f"{scratch_dir}/e")
    assert main(["rollup", "--purchases", f"{scratch_dir}/p", "--editions", f"{scratch_dir}/e",
                 "--as-of", "2024-06-15 12:00:00", "--out", f"{scratch_dir}/r", "--partition-by", "tipo_producto"]) == 0
    assert any(n.startswith("tipo_producto=") for n in os.listdir(f"{scratch_dir}/r"))
    want = rollup(purchases_df(spark, PS), editions_df(spark, EDS), AS_OF)
    got = read_rollup(spark, f"{scratch_dir}/r")
    assert sorted(got.collect()) == sorted(want.collect())


def test_command_line_strict_and_checkpoint(spark, scratch_dir):
    import pytest

    from edflux.cli import main

    write(purchases_df(spark, PS), f"{scratch_dir}/p")
    write(editions_df(spark, EDS + [edition(None, 1, 9, datetime(2024, 5, 1), datetime(2024, 5, 31))]), f"{scratch_dir}/e")
    base = ["rollup", "--purchases", f"{scratch_dir}/p", "--editions", f"{scratch_dir}/e", "--as-of", "2024-06-15 12:00:00"]
    assert main(base + ["--out", f"{scratch_dir}/ok", "--checkpoint"]) == 0
    want = rollup(purchases_df(spark, PS), editions_df(spark, EDS), AS_OF)
    assert sorted(read_rollup(spark, f"{scratch_dir}/ok").collect()) == sorted(want.collect())
    with pytest.raises(Exception):
        main(base + ["--out", f"{scratch_dir}/strict", "--strict"])


def test_reloaded_rollup_is_stored_compressed(spark):
    from pathlib import Path

    from edflux.plans.queries import QUERIES
    from edflux.session import ensure_checkpoint_dir

    assert QUERIES["rollup_recurrent_reloaded"](spark, "/root/testdata/sf0.001").count() > 0
    kept = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    newest = max(kept.glob("rollup-csv-*"), key=lambda p: p.stat().st_mtime)
    assert [*newest.glob("part-*.csv.gz")] and not [*newest.glob("part-*.csv")]
