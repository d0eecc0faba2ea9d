"""Hand-made cases: each rule and trap, checked against the Python model and by value."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from edflux.plans.rollup import SwitchingAnalysis, recurrent, rollup, rollup_single_window
from tests import model
from tests.helpers import by_keys, d, dicts, edition, editions_df, purchase, purchases_df

AS_OF = datetime(2024, 6, 15, 12, 0, 0)


def run(spark, purchases, editions, as_of=AS_OF, **kw):
    return dicts(rollup(purchases_df(spark, purchases), editions_df(spark, editions), as_of, **kw))


def check(spark, purchases, editions, as_of=AS_OF):
    got = by_keys(run(spark, purchases, editions, as_of))
    want = by_keys(model.rollup(purchases, editions, as_of))
    assert got == want
    return got


# Two products with monthly editions; type 1 numbers 1..6, type 2 numbers 1..6.
def monthly(tipo, first_key, months=6, start=datetime(2023, 12, 1)):
    eds = []
    for i in range(months):
        ini = datetime(start.year + (start.month - 1 + i) // 12, (start.month - 1 + i) % 12 + 1, 1)
        nxt = datetime(ini.year + ini.month // 12, ini.month % 12 + 1, 1)
        eds.append(edition(first_key + i, tipo, i + 1, ini, nxt - model.DAY))
    return eds


EDS = monthly(1, 100) + monthly(2, 200)


def test_every_class_appears(spark):
    # Edition 6 of each type runs 2024-05-01 .. 2024-05-31; closing week from 05-24.
    ps = [
        # person 1: bought type 1 edition 6 -> retained
        purchase(1, 105, d("2024-05-03"), 11),
        # person 2: bought type 1 in ed 6 and type 2 in May -> retained and others
        purchase(2, 105, d("2024-05-03"), 21),
        purchase(2, 205, d("2024-05-10"), 22),
        # person 3: only type 1 earlier, type 2 in the closing week of ed 6 -> lost in closing
        purchase(3, 104, d("2024-04-03"), 31),
        purchase(3, 205, d("2024-05-28"), 32),
        # person 4: type 1 earlier, type 2 in May before the closing week -> lost outside
        purchase(4, 104, d("2024-04-03"), 41),
        purchase(4, 205, d("2024-05-05"), 42),
        # person 5: type 1 earlier only -> churn
        purchase(5, 104, d("2024-04-03"), 51),
    ]
    rows = check(spark, ps, EDS)
    last = {r["clave_persona"]: r["canibalizacion_clase"] for r in rows if r["tipo_producto"] == 1 and r["ventana_numero"] == 0}
    assert last == {
        1: "RETENIDO",
        2: "RETENIDO_Y_OTROS",
        3: "PERDIDO_A_OTRO_EN_CIERRE",
        4: "PERDIDO_A_OTRO_FUERA_CIERRE",
        5: "CHURN_TOTAL",
    }


def test_windows_cover_editions_of_last_year_and_every_window_gets_a_row(spark):
    ps = [purchase(1, 100, d("2023-12-05"), 1)]
    rows = check(spark, ps, EDS)
    # Six monthly editions of type 1 ended within the year: windows 0..-5, one row each (D4).
    assert sorted(r["ventana_numero"] for r in rows) == [-5, -4, -3, -2, -1, 0]
    assert {r["canibalizacion_clase"] for r in rows if r["ventana_numero"] < -4} == {"RETENIDO"}


def test_history_counts_distinct_tickets_over_all_earlier_editions(spark):
    # The same ticket number bought in two earlier editions counts once (D3).
    ps = [
        purchase(1, 101, d("2024-01-03"), 7),
        purchase(1, 102, d("2024-02-03"), 7),
        purchase(1, 103, d("2024-03-03"), 8),
    ]
    rows = check(spark, ps, EDS)
    w0 = next(r for r in rows if r["ventana_numero"] == 0)
    assert w0["hist_boletos_pre_cierre"] == 2
    assert w0["hist_ediciones_distintas"] == 3
    detail = json.loads(w0["hist_detalle_por_edicion_json"])
    assert [x["boletos_pre_cierre"] for x in detail] == [1, 1, 1]


@pytest.mark.parametrize(
    "tickets_, expected",
    [([None, None, None], 3), ([None, 5, 5], 1), ([5, 6, None], 2), ([], 0)],
)
def test_ticket_rule_all_null_some_null_empty(spark, tickets_, expected):
    ps = [purchase(1, 105, d("2024-05-03"), b) for b in tickets_] + [purchase(1, 101, d("2024-01-03"), 1)]
    rows = check(spark, ps, EDS)
    w0 = next(r for r in rows if r["ventana_numero"] == 0)
    assert w0["ultima_boletos_pre_cierre"] == expected


def test_boundary_instants_of_the_flags(spark):
    # Edition 105: 2024-05-01 .. 2024-05-31 00:00; closing week starts 2024-05-24 00:00.
    ps = [
        purchase(1, 105, d("2024-05-01 00:00:00"), 1),  # exactly ini -> pre
        purchase(1, 105, d("2024-04-30 23:59:59"), 2),  # just before ini -> neither
        purchase(1, 105, d("2024-05-24 00:00:00"), 3),  # exactly fin-7d -> closing
        purchase(1, 105, d("2024-05-23 23:59:59"), 4),  # just before -> pre
        purchase(1, 105, d("2024-05-31 00:00:00"), 5),  # exactly fin -> closing
        purchase(1, 105, d("2024-05-31 00:00:01"), 6),  # after fin (same day) -> neither (D11)
    ]
    rows = check(spark, ps, EDS)
    w0 = next(r for r in rows if r["ventana_numero"] == 0)
    assert (w0["ultima_boletos_pre_cierre"], w0["ultima_boletos_semana_cierre"]) == (2, 2)


def test_recent_cut_is_strict_and_window_horizon_inclusive(spark):
    as_of = datetime(2024, 6, 15, 12, 0, 0)
    midnight = datetime(2024, 6, 15)
    eds = [
        edition(1, 1, 10, datetime(2024, 6, 1), as_of),  # ends exactly at as_of -> not recent
        edition(2, 1, 9, datetime(2024, 5, 1), datetime(2024, 6, 15, 6)),  # ended today after midnight
        edition(3, 1, 8, datetime(2023, 6, 1), midnight - 365 * model.DAY),  # horizon, kept
        edition(4, 1, 7, datetime(2022, 5, 1), as_of - 730 * model.DAY),  # exactly 730d -> not recent
    ]
    ps = [purchase(1, k, d("2024-01-01"), 1) for k in (1, 2, 3, 4)]
    rows = check(spark, ps, eds, as_of)
    # Edition 9 ended after midnight: recent (its purchases count) but not a window (D8).
    assert [(r["ventana_numero"], r["numero_sorteo_ultima"]) for r in rows] == [(0, 8)]


def test_walk_stops_at_first_old_edition_even_if_lower_numbers_ended_later(spark):
    eds = [
        edition(1, 1, 5, datetime(2024, 4, 1), datetime(2024, 5, 1)),
        edition(2, 1, 4, datetime(2023, 1, 1), datetime(2023, 2, 1)),  # old -> stop here
        edition(3, 1, 3, datetime(2024, 1, 1), datetime(2024, 2, 1)),  # recent but below the stop
    ]
    ps = [purchase(1, 3, d("2024-01-05"), 1)]
    rows = check(spark, ps, eds)
    assert [r["numero_sorteo_ultima"] for r in rows] == [5]


def test_duplicate_edition_key_does_not_multiply_purchases(spark):
    eds = EDS + [edition(105, 1, 6, datetime(2024, 5, 1), datetime(2024, 5, 31))]
    ps = [purchase(1, 105, d("2024-05-03"), None), purchase(1, 104, d("2024-04-03"), None)]
    rows = run(spark, ps, eds)
    w0 = next(r for r in rows if r["ventana_numero"] == 0)
    assert w0["ultima_boletos_pre_cierre"] == 1
    assert sum(1 for r in rows if r["ventana_numero"] == 0) == 1


def test_edition_without_type_or_number_is_dropped_or_fails_when_strict(spark):
    eds = EDS + [edition(999, None, 3, datetime(2024, 5, 1), datetime(2024, 5, 31))]
    ps = [purchase(1, 105, d("2024-05-03"), 1), purchase(1, 999, d("2024-05-03"), 2)]
    check(spark, ps, eds)
    with pytest.raises(Exception):
        run(spark, ps, eds, strict=True)


def test_two_keys_share_a_type_and_number(spark):
    # Numbers are the identity of the as-of cut (D13): both keys count as edition 6.
    eds = EDS + [edition(150, 1, 6, datetime(2024, 5, 2), datetime(2024, 5, 30))]
    ps = [
        purchase(1, 105, d("2024-05-03"), 1),
        purchase(1, 150, d("2024-05-04"), 2),
        purchase(1, 101, d("2024-01-04"), 3),
    ]
    rows = check(spark, ps, eds)
    assert sorted(r["clave_edicion_producto_ultima"] for r in rows if r["numero_sorteo_ultima"] == 6) == [105, 150]


def test_edition_shorter_than_closing_week(spark):
    eds = [edition(1, 1, 2, datetime(2024, 5, 28), datetime(2024, 5, 31)), edition(2, 1, 1, datetime(2024, 5, 1), datetime(2024, 5, 27))]
    ps = [purchase(1, 1, d("2024-05-29"), 1), purchase(1, 2, d("2024-05-20"), 2)]
    rows = check(spark, ps, eds)
    w0 = next(r for r in rows if r["ventana_numero"] == 0)
    assert w0["ultima_boletos_semana_cierre"] == 1


def test_null_customer_and_null_time_are_dropped(spark):
    ps = [purchase(None, 105, d("2024-05-03"), 1), purchase(1, 105, None, 2), purchase(1, 104, d("2024-04-03"), 3)]
    rows = check(spark, ps, EDS)
    assert {r["clave_persona"] for r in rows} == {1}


def test_no_purchases_gives_empty_result_with_schema(spark):
    df = rollup(purchases_df(spark, []), editions_df(spark, EDS), AS_OF)
    assert df.count() == 0
    assert len(df.columns) == 21


def test_recurrent_filter_thresholds(spark):
    ps = [
        purchase(1, 103, d("2024-03-03"), 1),
        purchase(1, 104, d("2024-04-03"), 2),
        purchase(2, 104, d("2024-04-03"), 3),
    ]
    df = rollup(purchases_df(spark, ps), editions_df(spark, EDS), AS_OF)
    for k in (1, 2):
        got = sorted((r["clave_persona"], r["ventana_numero"]) for r in recurrent(df, k).collect())
        want = sorted(
            (r["clave_persona"], r["ventana_numero"])
            for r in model.rollup(ps, EDS, AS_OF)
            if r["hist_ediciones_distintas"] >= k
        )
        assert got == want


def test_other_purchases_of_open_editions_never_count(spark):
    # An edition still on sale at as_of is not recent, so its purchases are dropped (D5).
    eds = EDS + [edition(300, 3, 1, datetime(2024, 5, 1), datetime(2024, 7, 1))]
    ps = [purchase(1, 104, d("2024-04-03"), 1), purchase(1, 300, d("2024-05-28"), 2)]
    rows = check(spark, ps, eds)
    assert all(r["otros_boletos_en_semana_cierre_del_producto"] == 0 for r in rows)


def test_single_window_variant_against_model(spark):
    eds = EDS + [edition(107, 1, 7, None, datetime(2024, 6, 30))]  # latest edition, start unknown
    ps = [
        purchase(1, 104, d("2024-04-03"), 1),
        purchase(1, 205, d("2024-05-28"), 2),
        purchase(2, 107, d("2024-06-03"), 3),
        purchase(2, 106, d("2024-06-03"), 4),
    ]
    got = by_keys(dicts(rollup_single_window(purchases_df(spark, ps), editions_df(spark, eds))), ["clave_persona", "tipo_producto"])
    want = by_keys(model.single_window(ps, eds), ["clave_persona", "tipo_producto"])
    assert got == want
    # Type 1's latest edition has no start: its start is taken from the next lower number.
    assert {r["ultima_fecha_inicio"] for r in got if r["tipo_producto"] == 1.0} == {datetime(2024, 5, 1).date()}


def test_analysis_exposes_intermediate_tables(spark):
    ps = [purchase(1, 104, d("2024-04-03"), 1)]
    a = SwitchingAnalysis(purchases_df(spark, ps), editions_df(spark, EDS), AS_OF)
    assert a.windows.count() == 12
    assert a.flagged.where("en_pre_cierre").count() == 1


def test_coarse_time_buckets_give_the_same_result(spark):
    # A tiny bucket bound forces multi-day buckets in the window lookup.
    ps = [
        purchase(p, k, d(t), b)
        for p, k, t, b in [
            (1, 104, "2024-04-03", 1), (1, 205, "2024-05-28", 2), (1, 204, "2024-04-29 23:00:00", 3),
            (2, 105, "2024-05-03", 4), (2, 203, "2024-03-31", 5), (3, 201, "2024-01-15", None),
            (3, 102, "2024-02-27", 6), (3, 202, "2024-02-27", 6),
        ]
    ]
    a = SwitchingAnalysis(purchases_df(spark, ps), editions_df(spark, EDS), AS_OF, max_bucket_rows=30)
    assert a.core.span.width_days > 1
    assert by_keys(dicts(a.rollup)) == by_keys(model.rollup(ps, EDS, AS_OF))


def test_rows_without_purchase_key_still_give_a_first_row(spark):
    ps = [
        {**purchase(1, 101, d("2024-01-03"), 1), "clave_detalle_compra": None},
        purchase(1, 104, d("2024-04-03"), 2),
    ]
    rows = run(spark, ps, EDS)
    w0 = next(r for r in rows if r["ventana_numero"] == 0)
    detail = json.loads(w0["hist_detalle_por_edicion_json"])
    assert [x["clave_edicion_producto"] for x in detail] == [101, 104]


def test_fallbacks_beyond_the_broadcast_bounds_give_the_same_result(spark):
    ps = [
        purchase(1, 104, d("2024-04-03"), 1), purchase(1, 205, d("2024-05-28"), 2),
        purchase(2, 105, d("2024-05-03"), 3), purchase(2, 203, d("2024-03-31"), None),
    ]
    a = SwitchingAnalysis(purchases_df(spark, ps), editions_df(spark, EDS), AS_OF, max_broadcast_rows=1, max_bucket_rows=4)
    assert a.core.span.n_windows > a.core.max_windows and not a.core.span.fits
    assert by_keys(dicts(a.rollup)) == by_keys(model.rollup(ps, EDS, AS_OF))
