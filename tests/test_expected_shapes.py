"""The expected shapes of FIXTURES.md (computed there with throwaway SQL), on the driver tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from edflux.plans.queries import QUERIES
from edflux.plans.rollup import SwitchingAnalysis
from edflux.sources.fixtures import FIXTURE_AS_OF, fixture_editions, fixture_purchases

EXPECTED = {
    "/root/testdata/sf0.001": dict(
        purchases=6_000, recent_purchases=1_737, flags=(42, 1_343, 352), rows=4_204,
        classes={"CHURN_TOTAL": 3_294, "PERDIDO_A_OTRO_EN_CIERRE": 95, "PERDIDO_A_OTRO_FUERA_CIERRE": 365,
                 "RETENIDO": 22, "RETENIDO_Y_OTROS": 428},
        recurrent=(3_576, 1_578),
    ),
    "/root/testdata/sf0.01": dict(
        purchases=60_000, recent_purchases=19_260, flags=(434, 15_026, 3_800), rows=43_775,
        classes={"CHURN_TOTAL": 33_418, "PERDIDO_A_OTRO_EN_CIERRE": 1_054, "PERDIDO_A_OTRO_FUERA_CIERRE": 4_083,
                 "RETENIDO": 206, "RETENIDO_Y_OTROS": 5_014},
        recurrent=(37_072, 17_025),
    ),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_expected_shapes(spark, sf):
    want = EXPECTED[sf]
    a = SwitchingAnalysis(fixture_purchases(spark, sf), fixture_editions(spark, sf), FIXTURE_AS_OF)
    assert a.purchases.count() == want["purchases"]
    assert a.editions.count() == 252
    assert a.recent.count() == 76
    wins = {r[0]: r[1] for r in a.windows.groupBy("tipo_producto").count().collect()}
    assert [wins[t] for t in range(1, 7)] == [9, 8, 6, 5, 5, 4]
    f = a.flagged
    assert f.count() == want["recent_purchases"]
    closing = f.where("en_semana_cierre").count()
    pre = f.where("en_pre_cierre").count()
    assert (closing, pre, f.count() - closing - pre) == want["flags"]
    r = a.rollup
    assert r.count() == want["rows"]
    assert {x[0]: x[1] for x in r.groupBy("canibalizacion_clase").count().collect()} == want["classes"]
    assert (
        r.where(F.col("hist_ediciones_distintas") >= 1).count(),
        r.where(F.col("hist_ediciones_distintas") >= 2).count(),
    ) == want["recurrent"]
    assert QUERIES["rollup_recurrent"](spark, sf).count() == want["recurrent"][1]
