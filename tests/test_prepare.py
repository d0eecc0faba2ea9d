"""Casts, time parsing, labels and the quality counters."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from edflux.functions import item_completo, lenient_int, parse_purchase_time, strict_long
from edflux.operators.prepare import clean_editions, dedup_editions, edition_labels
from edflux.operators.quality import observe_flags, quality_counters
from edflux.plans.rollup import SwitchingAnalysis
from edflux.schemas import EDITIONS_TEXT
from tests.helpers import d, edition, editions_df, purchase, purchases_df


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-02 03:04:05.123456", datetime(2024, 1, 2, 3, 4, 5, 123456)),
        ("2024-01-02 03:04:05", datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02", None),  # date only
        ("2024-01-02T03:04:05", None),  # T separator
        ("2024-01-02 03:04:05+00:00", None),  # zone suffix
        ("", None),
        (None, None),
        ("2024-1-2 3:4:5", None),  # unpadded: not accepted (D17)
    ],
)
def test_purchase_time_formats(spark, text, expected):
    assert one(spark, parse_purchase_time, text) == expected


def test_lenient_int_truncates_and_keeps_null(spark):
    assert one(spark, lenient_int, "1.0") == 1
    assert one(spark, lenient_int, "-1.7") == -1
    assert one(spark, lenient_int, " ") is None
    assert one(spark, lenient_int, None) is None


def test_strict_key_rejects_float_text(spark):
    assert one(spark, strict_long, "123") == 123
    with pytest.raises(Exception):
        one(spark, strict_long, "1.0")


def test_clean_editions_from_text(spark):
    raw = spark.createDataFrame(
        [("7", "1.0", "12.0", "SORTEO 1", "S1", "2024-01-01 00:00:00", "2024-02-01 00:00:00", "")],
        EDITIONS_TEXT,
    )
    row = clean_editions(raw).first()
    assert (row["clave_edicion_producto"], row["tipo_producto"], row["numero_sorteo"]) == (7, 1, 12)
    assert row["fecha_fin"] == datetime(2024, 2, 1) and row["fecha_celebracion"] is None


def test_item_completo_null_propagates(spark):
    df = spark.createDataFrame([("SORTEO 1", 5), (None, 6)], "desc_sorteo string, numero_sorteo int")
    got = [r[0] for r in df.select(item_completo(F.col("desc_sorteo"), F.col("numero_sorteo"))).collect()]
    assert got == ["SORTEO 1 5", None]


def test_dedup_is_deterministic(spark):
    eds = [
        edition(1, 1, 5, datetime(2024, 1, 1), datetime(2024, 2, 1)),
        edition(1, 1, 6, datetime(2024, 2, 1), datetime(2024, 3, 1)),
    ]
    for parts in (1, 3):
        got = dedup_editions(editions_df(spark, eds).repartition(parts)).collect()
        assert [(r["clave_edicion_producto"], r["numero_sorteo"]) for r in got] == [(1, 6)]


def test_edition_labels(spark):
    got = edition_labels(editions_df(spark, [edition(1, 2, 9, None, datetime(2024, 1, 1), desc="SUPER")])).first()
    assert got["item_completo"] == "SUPER 9"


def test_quality_counters_and_observation(spark):
    eds = [
        edition(1, 1, 1, datetime(2024, 5, 1), datetime(2024, 5, 31)),
        edition(1, 1, 1, datetime(2024, 5, 1), datetime(2024, 5, 31)),
    ]
    ps = [purchase(1, 1, d("2024-05-02"), 1), purchase(None, 1, d("2024-05-29"), 2), purchase(2, 1, None, 3)]
    a = SwitchingAnalysis(purchases_df(spark, ps), editions_df(spark, eds), datetime(2024, 6, 15, 12))
    counters = {r["metric"]: r["value"] for r in quality_counters(a.purchases, a.editions, a.recent, a.windows).collect()}
    assert counters["compras"] == 3 and counters["compras_sin_fecha"] == 1
    assert counters["sorteos_clave_duplicada"] == 1 and counters["compras_validas"] == 2
    assert counters["en_semana_cierre"] == 1 and counters["en_pre_cierre"] == 1
    observed, obs = observe_flags(a.flagged)
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["compras_validas"] == 2


def test_strict_editions_reject_null_keys(spark):
    raw = spark.createDataFrame(
        [(None, "1", "2", "S", "S1", "2024-01-01 00:00:00", "2024-02-01 00:00:00", None)], EDITIONS_TEXT
    )
    assert clean_editions(raw).count() == 1
    with pytest.raises(Exception):
        clean_editions(raw, strict=True).collect()
