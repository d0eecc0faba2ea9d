"""Property tests: random small tables, Spark rollup == Python model, plus invariants."""

from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from edflux.plans.rollup import rollup
from tests import model
from tests.helpers import by_keys, dicts, edition, editions_df, purchase, purchases_df

AS_OF = datetime(2024, 6, 15, 12, 0, 0)
BASE = datetime(2023, 6, 1)


@st.composite
def tables(draw):
    eds = []
    key = 1
    for tipo in (1, 2, 3):
        n = draw(st.integers(1, 5))
        for num in range(1, n + 1):
            start_day = draw(st.integers(0, 420))
            length = draw(st.integers(2, 60))
            ini = BASE + timedelta(days=start_day) if draw(st.booleans()) or num > 1 else None
            start = ini or BASE + timedelta(days=start_day)
            eds.append(edition(key, tipo, num, ini, start + timedelta(days=length)))
            key += 1
    n_p = draw(st.integers(0, 40))
    ps = []
    for i in range(n_p):
        e = draw(st.sampled_from(eds))
        anchor = e["fecha_inicio"] or e["fecha_fin"] - timedelta(days=30)
        offset = draw(st.integers(-10, 70))
        t = anchor + timedelta(days=offset, hours=draw(st.sampled_from([0, 6, 23])))
        ps.append(
            purchase(
                draw(st.sampled_from([1, 2, 3, None])),
                e["clave_edicion_producto"],
                t,
                draw(st.sampled_from([None, 1, 2, 3, 4])),
                cdc=i + 1,
            )
        )
    return ps, eds


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tables())
def test_spark_matches_model(spark, data):
    ps, eds = data
    got = by_keys(dicts(rollup(purchases_df(spark, ps), editions_df(spark, eds), AS_OF)))
    want = by_keys(model.rollup(ps, eds, AS_OF))
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tables(), st.integers(1, 7))
def test_invariants_and_partition_independence(spark, data, parts):
    ps, eds = data
    purchases = purchases_df(spark, ps)
    editions = editions_df(spark, eds)
    base = rollup(purchases, editions, AS_OF)
    rows = dicts(base)
    # Rows = pairs x windows of the pair's type; classes partition the rows.
    _, enr = model.enrich(ps, eds, AS_OF)
    recent_keys = {e["clave_edicion_producto"] for e in eds if AS_OF - timedelta(days=730) < e["fecha_fin"] < AS_OF}
    wins = model.windows([e for e in eds if e["clave_edicion_producto"] in recent_keys], AS_OF)
    pairs = {(r["clave_persona"], r["tipo_producto"]) for r in enr if r["clave_persona"] is not None}
    assert len(rows) == sum(len(wins.get(t, [])) for _, t in pairs)
    assert all(r["canibalizacion_clase"] for r in rows)
    # Same result whatever the input partitioning.
    shuffled = rollup(purchases.repartition(parts), editions.repartition(parts), AS_OF)
    assert by_keys(dicts(shuffled)) == by_keys(rows)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tables())
def test_single_window_matches_model(spark, data):
    from edflux.plans.rollup import rollup_single_window

    ps, eds = data
    keys = ["clave_persona", "tipo_producto"]
    got = by_keys(dicts(rollup_single_window(purchases_df(spark, ps), editions_df(spark, eds))), keys)
    assert got == by_keys(model.single_window(ps, eds), keys)
