"""CSV files as other programs write and read them, and outputs that would delete their input."""

from __future__ import annotations

import csv
import glob
import json

import pytest

from edflux.operators.flow import lost_destinations, migration_flow
from edflux.plans.queries import QUERIES
from edflux.plans.rollup import recurrent
from edflux.schemas import ROLLUP_COLUMNS
from edflux.sources.fixtures import fixture_editions
from edflux.sources.io import read_editions, read_purchases, read_rollup, write

SF = "/root/testdata/sf0.001"


def save(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\n").writerows(rows)
    return path


@pytest.fixture(scope="module")
def rollup(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rollup") / "r")
    write(QUERIES["rollup_full"](spark, SF), path)
    return path


def test_rollup_written_by_the_csv_module(spark, rollup, tmp_path):
    rows = spark.read.parquet(rollup).collect()
    names = ["extra", *reversed(ROLLUP_COLUMNS)]
    path = save(str(tmp_path / "r.csv"), [names, *(["a\nb", *(getattr(r, c) for c in names[1:])] for r in rows)])
    stored = read_rollup(spark, path, "csv")
    assert stored.columns == ROLLUP_COLUMNS and sorted(map(str, stored.collect())) == sorted(map(str, rows))
    own = spark.read.parquet(rollup)
    assert lost_destinations(stored).count() == lost_destinations(own).count() > 0
    flow = migration_flow(stored, fixture_editions(spark, SF)).collect()
    assert sorted(map(str, flow)) == sorted(map(str, migration_flow(own, fixture_editions(spark, SF)).collect()))
    order = [(r.producto_origen_tag is not None, r.producto_origen_tag or "", -r.clientes_perdidos) for r in flow]
    assert order == sorted(order)


def test_our_csv_is_read_by_the_csv_module(spark, rollup, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.read.parquet(rollup)
    write(rows, path, "csv")
    got = [r for f in glob.glob(f"{path}/part-*") for r in csv.DictReader(open(f, newline="", encoding="utf-8"))]
    want = sorted(r.hist_detalle_por_edicion_json for r in rows.collect())
    assert sorted(r["hist_detalle_por_edicion_json"] for r in got) == want
    assert all(isinstance(json.loads(r["otros_detalle_en_ventana_ultima_json"]), list) for r in got)
    assert sorted(map(str, read_rollup(spark, path, "csv").collect())) == sorted(map(str, rows.collect()))


def test_columns_go_by_name(spark, tmp_path):
    head = ["extra", "numero_sorteo", "tipo_producto", "clave_edicion_producto", "desc_sorteo", "fecha_fin", "fecha_inicio"]
    path = save(str(tmp_path / "s.csv"), [head, ["x", "7.0", "2", "90", 'a "b", c', "2024-02-01 00:00:00", "2024-01-01 00:00:00"]])
    row = read_editions(spark, path, "csv").first()
    assert (row.tipo_producto, row.numero_sorteo, row.desc_sorteo, row.desc_corta_sorteo) == (2, 7, 'a "b", c', None)


def test_wide_ids_stay_exact(spark, tmp_path):
    head = ["numero_boleto", "clave_persona", "clave_detalle_compra", "clave_edicion_producto", "fecha_rotulacion_finalizacion"]
    rows = [["00123", "9007199254740993", "1", "5", "2024-01-01 00:00:00"], ["123.0", "9007199254740992", "9223372036854775807", "5.0", ""]]
    got = read_purchases(spark, save(str(tmp_path / "p.csv"), [head, *rows]), "csv").collect()
    assert {r.clave_persona for r in got} == {9007199254740993, 9007199254740992}
    assert {r.numero_boleto for r in got} == {123} and {r.clave_detalle_compra for r in got} == {1, 2**63 - 1}


def test_broken_detail_text_fails(spark, rollup):
    rows = spark.read.parquet(rollup).where("canibalizacion_clase = 'PERDIDO_A_OTRO_EN_CIERRE'")
    cut = rows.selectExpr(*[c for c in ROLLUP_COLUMNS[:-1]], "substring(otros_detalle_en_ventana_ultima_json, 1, 9) as otros_detalle_en_ventana_ultima_json")
    with pytest.raises(Exception, match="detail list is no JSON"):
        lost_destinations(cut).collect()


def test_output_over_its_input_replaces_it(spark, rollup, tmp_path):
    rows = spark.read.parquet(rollup)
    write(rows, str(tmp_path / "own"))
    want = sorted(recurrent(rows).collect())
    for place in (str(tmp_path / "own"), f"file://{tmp_path}/own/"):
        write(recurrent(read_rollup(spark, str(tmp_path / "own"))), place)
        assert sorted(read_rollup(spark, str(tmp_path / "own")).collect()) == want
    write(rows, "own_rollup", "table")
    write(recurrent(read_rollup(spark, "own_rollup", "table")), "own_rollup", "table")
    assert sorted(read_rollup(spark, "own_rollup", "table").collect()) == want
