"""Words for missing values, rejected rows, and results that don't depend on the order of rows."""

from __future__ import annotations

import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from edflux.constants import PURCHASE_TIME_PATTERN
from edflux.functions.casts import NULL_TOKENS, lenient_int, lenient_long, number_problem, strict_long
from edflux.functions.dates import parse_purchase_time
from edflux.operators.prepare import dedup_editions
from edflux.operators.rejects import tolerant_editions, tolerant_purchases
from edflux.plans.rollup import rollup
from edflux.sources.io import read_editions, read_purchases
from tests.helpers import edition, editions_df, purchase, purchases_df

AS_OF = datetime(2024, 6, 15, 12)


def test_words_for_missing_values(spark):
    rows = spark.createDataFrame([(t,) for t in (*NULL_TOKENS, "", " ", " NA ", None)], "t string")
    got = rows.select(lenient_int(F.col("t")).alias("a"), strict_long(F.col("t")).alias("b")).collect()
    assert all(r.a is None and r.b is None for r in got)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("na",)], "t string").select(lenient_int(F.col("t"))).collect()


def test_csv_extracts_with_missing_values(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "clave_detalle_compra,clave_persona,clave_edicion_producto,fecha_rotulacion_finalizacion,numero_boleto,clave_rotulo\n"
        "1,NA,104,2024-04-03 00:00:00,null,None\n2,7.0,104.0,nan,00123,x NA\n"
    )
    rows = read_purchases(spark, str(tmp_path / "p.csv"), "csv").collect()
    assert [(r.clave_persona, r.numero_boleto, r.clave_rotulo) for r in rows] == [(None, None, None), (7, 123, "x NA")]
    assert rows[1].fecha_rotulacion_finalizacion is None
    (tmp_path / "e.csv").write_text("clave_edicion_producto,tipo_producto,numero_sorteo,desc_sorteo,fecha_fin\n5,NaN,#N/A,N/A,NULL\n")
    row = read_editions(spark, str(tmp_path / "e.csv"), "csv").first()
    assert (row.clave_edicion_producto, row.tipo_producto, row.numero_sorteo, row.desc_sorteo, row.fecha_fin) == (5, None, None, None, None)


def test_rejected_purchases(spark):
    raw = spark.createDataFrame(
        [("1", "5", "7", "1.5"), ("2", "x", "7", "y"), (None, "NA", " 8 ", "9223372036854775808"), ("4", "1e3", "9" * 50, "-3"), ("5", "null", "", "00012.0")],
        "clave_detalle_compra string, clave_persona string, clave_edicion_producto string, numero_boleto string",
    )
    kept, told = tolerant_purchases(raw)
    assert {(r.clave_detalle_compra, r.clave_persona, r.numero_boleto) for r in kept.collect()} == {(1, 5, 1), (5, None, 12)}
    got = {(r.clave_detalle_compra, r.columna, r.valor, r.motivo) for r in told.collect()}
    assert {(a, b, d) for a, b, _, d in got if a != "4"} == {
        ("2", "clave_persona", "not a number"),
        ("2", "numero_boleto", "not a number"),
        (None, "numero_boleto", "out of range"),
    }
    assert ("4", "clave_edicion_producto", "9" * 50, "out of range") in got
    assert all('"clave_persona":"x"' in r.fila for r in told.collect() if r.clave_detalle_compra == "2")
    assert kept.count() + told.select("fila").distinct().count() == raw.count()


def test_rejected_editions_and_typed_input(spark):
    raw = spark.createDataFrame([("1.0", "1", "5", "2024-01-01 00:00:00"), ("2", "1.0", "NA", "soon"), ("3", "2", "6.0", "")], "clave_edicion_producto string, tipo_producto string, numero_sorteo string, fecha_fin string")
    kept, told = tolerant_editions(raw)
    assert [(r.clave_edicion_producto, r.tipo_producto, r.numero_sorteo) for r in kept.collect()] == [(3, 2, 6)]
    assert {(r.clave_edicion_producto, r.columna, r.motivo) for r in told.collect()} == {("1.0", "clave_edicion_producto", "not a whole number"), ("2", "fecha_fin", "not a time")}
    typed = purchases_df(spark, [purchase(1, 5, datetime(2024, 1, 1))])
    kept, told = tolerant_purchases(typed)
    assert kept.count() == 1 and told.count() == 0


def test_rollup_is_the_same_in_any_row_order(spark):
    """Repeated and null purchase keys, and two editions of one type and number."""
    eds = [
        edition(104, 1, 5, datetime(2024, 4, 1), datetime(2024, 4, 30)),
        edition(107, 1, 5, datetime(2024, 4, 1), datetime(2024, 4, 28)),
        edition(105, 1, 6, datetime(2024, 5, 1), datetime(2024, 5, 31)),
        edition(205, 2, 6, datetime(2024, 5, 1), datetime(2024, 5, 31)),
        edition(206, 2, 6, datetime(2024, 5, 2), datetime(2024, 5, 30)),
    ]
    bought = [purchase(1, k, t, b) for k, t, b in ((104, datetime(2024, 4, 3), 1), (107, datetime(2024, 4, 4), 2), (205, datetime(2024, 5, 28), 3), (206, datetime(2024, 5, 27), 4))]
    results = set()
    for cdc in (9, None):
        same = [p | {"clave_detalle_compra": cdc} for p in bought]
        for order in itertools.islice(itertools.permutations(same), 0, 24, 5):
            rows = rollup(purchases_df(spark, list(order)).coalesce(1), editions_df(spark, eds), AS_OF).collect()
            results.add(tuple(sorted(map(str, rows))))
    assert len(results) == 1
    text = next(iter(results))
    assert any('"clave_edicion_producto":104' in r for r in text) and not any('"clave_edicion_producto":107' in r for r in text)


def test_repeated_editions_are_resolved_in_any_order(spark):
    a = edition(104, 1, 5, datetime(2024, 4, 1), datetime(2024, 4, 30), short="B")
    b = a | {"desc_corta_sorteo": "A"}
    c = b | {"fecha_celebracion": datetime(2024, 5, 1)}
    for rows in itertools.permutations([a, b, c]):
        got = dedup_editions(editions_df(spark, list(rows)).coalesce(1)).collect()
        assert [(r.desc_corta_sorteo, r.fecha_celebracion) for r in got] == [("A", datetime(2024, 5, 1))]


def test_number_rules_at_their_bounds(spark):
    cases = {
        "9223372036854775807": None, "9223372036854775807.9": None, "9223372036854775808": "out of range",
        "-9223372036854775808": None, "-9223372036854775808.5": None, "-9223372036854775809": "out of range",
        "99999999999999999999": "out of range", "9" * 40: "out of range", "1e3": None, ".5": None, "+7.": None, "\t7": None,
        " 12 ": None, "abc": "not a number", "1.x": "not a number", "-": "not a number", "1\nx": "not a number", "NA": None, "": None,
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.why for r in rows.select("t", number_problem(F.col("t"), "bigint").alias("why")).collect()} == cases
    good = {"9223372036854775807.9": 2**63 - 1, "-1.7": -1, "-0.5": 0, "1." + "9" * 17: 1, "1." + "9" * 19: 2, "1e3": 1000, " 12 ": 12, "00123": 123, "+7.": 7}
    rows = spark.createDataFrame([(t,) for t in good], "t string")
    assert {r.t: r.n for r in rows.select("t", lenient_long(F.col("t")).alias("n")).collect()} == good


def test_usual_times_are_read_as_the_pattern_reads_them(spark):
    texts = ["2024-02-29 23:59:59", "2023-02-29 00:00:00", "0000-01-01 00:00:00", "2024-01-01 24:00:00", "2024-01-01 00:00:00\n", "2024-01-01 00:00:00.5", "2024-1-1 0:0:0"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    fmt = F.lit(PURCHASE_TIME_PATTERN)
    want = F.when(F.try_to_timestamp("t", fmt).isNotNull(), F.to_timestamp_ntz("t", fmt))
    pairs = rows.select(parse_purchase_time(F.col("t")).cast("string").alias("got"), want.cast("string").alias("want")).collect()
    assert [r.got for r in pairs] == [r.want for r in pairs] and pairs[0].got == "2024-02-29 23:59:59"
