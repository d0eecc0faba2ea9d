"""A slow, obviously-correct Python model of the rollup rules, for tests only.

Written from the rule descriptions (README / SURVEY), one nested loop per rule, so that
the Spark plans (histograms, bucketed broadcast joins, higher-order functions) are
checked against a direct statement of the semantics. Inputs are lists of dicts with the
typed columns; editions are assumed unique per key unless a test says otherwise.
"""

from __future__ import annotations

import json
from collections import defaultdict
from datetime import datetime, timedelta

DAY = timedelta(days=1)


def tickets(rows):
    """Distinct non-null ticket numbers if any, else the number of rows."""
    numbers = {r["numero_boleto"] for r in rows if r["numero_boleto"] is not None}
    return len(numbers) if numbers else len(rows)


def _between(t, lo, hi):
    return lo is not None and hi is not None and t is not None and lo <= t <= hi


def enrich(purchases, editions, as_of, lookback_days=730, closing_days=7):
    recent = {
        e["clave_edicion_producto"]: e
        for e in editions
        if e["fecha_fin"] is not None and as_of - lookback_days * DAY < e["fecha_fin"] < as_of
    }
    out = []
    for p in purchases:
        e = recent.get(p["clave_edicion_producto"])
        t = p["fecha_rotulacion_finalizacion"]
        if e is None or t is None or e["tipo_producto"] is None or e["numero_sorteo"] is None:
            continue
        fin, ini = e["fecha_fin"], e["fecha_inicio"]
        closing_start = fin - closing_days * DAY
        row = dict(p)
        row.update(
            tipo_producto=e["tipo_producto"],
            numero_sorteo=e["numero_sorteo"],
            fecha_inicio=ini,
            fecha_fin=fin,
            en_semana_cierre=closing_start <= t <= fin,
            en_pre_cierre=ini is not None and ini <= t < closing_start,
        )
        out.append(row)
    return list(recent.values()), out


def windows(recent, as_of, window_days=365):
    today = datetime(as_of.year, as_of.month, as_of.day)
    cutoff = today - window_days * DAY
    by_type = defaultdict(list)
    for e in recent:
        if None not in (e["clave_edicion_producto"], e["tipo_producto"], e["numero_sorteo"]):
            by_type[e["tipo_producto"]].append(e)
    result = {}
    for tp, eds in by_type.items():
        eds.sort(key=lambda e: (-e["numero_sorteo"], e["clave_edicion_producto"]))
        chosen = []
        for e in eds:
            if e["fecha_fin"] < cutoff:
                break
            if e["fecha_fin"] <= today:
                chosen.append(e)
        if chosen:
            result[tp] = [(-i, e) for i, e in enumerate(chosen)]
    return result


def _first(rows, col):
    return min(rows, key=lambda r: r["clave_detalle_compra"])[col]


def rollup(purchases, editions, as_of, lookback_days=730, window_days=365, closing_days=7):
    recent, enr = enrich(purchases, editions, as_of, lookback_days, closing_days)
    wins = windows(recent, as_of, window_days)
    return _rows(enr, wins, closing_days)


def _rows(enr, wins, closing_days):
    out = []
    pairs = sorted({(r["clave_persona"], r["tipo_producto"]) for r in enr if r["clave_persona"] is not None})
    for persona, tipo in pairs:
        mine = [r for r in enr if r["clave_persona"] == persona and r["tipo_producto"] == tipo]
        customer = [r for r in enr if r["clave_persona"] == persona]
        for vn, w in wins.get(tipo, []):
            ns = w["numero_sorteo"]
            ini, fin = w["fecha_inicio"], w["fecha_fin"]
            hist = [r for r in mine if r["numero_sorteo"] < ns]
            last = [r for r in mine if r["numero_sorteo"] == ns]
            last_pre = tickets([r for r in last if r["en_pre_cierre"]])
            last_closing = tickets([r for r in last if r["en_semana_cierre"]])
            bought = last_pre + last_closing > 0

            hist_detail = []
            for n in sorted({r["numero_sorteo"] for r in hist}):
                ed = [r for r in hist if r["numero_sorteo"] == n]
                hist_detail.append(
                    {
                        "numero_sorteo": n,
                        "tipo_producto": str(tipo),
                        "id_sorteo": f"{tipo}-{n}",
                        "clave_edicion_producto": _first(ed, "clave_edicion_producto"),
                        "boletos_pre_cierre": tickets([r for r in ed if r["en_pre_cierre"]]),
                        "boletos_semana_cierre": tickets([r for r in ed if r["en_semana_cierre"]]),
                        "fecha_fin_edicion": _first(ed, "fecha_fin").strftime("%Y-%m-%d"),
                    }
                )

            others = [
                r
                for r in customer
                if r["tipo_producto"] != tipo and _between(r["fecha_rotulacion_finalizacion"], ini, fin)
            ]
            other_detail = []
            closing_total = outside_total = 0
            for tp2, ns2 in sorted({(r["tipo_producto"], r["numero_sorteo"]) for r in others}):
                g = [r for r in others if r["tipo_producto"] == tp2 and r["numero_sorteo"] == ns2]
                in_closing = [
                    r for r in g if fin - closing_days * DAY <= r["fecha_rotulacion_finalizacion"] <= fin
                ]
                outside = [r for r in g if r not in in_closing]
                c, o = tickets(in_closing), tickets(outside)
                closing_total += c
                outside_total += o
                other_detail.append(
                    {
                        "tipo_producto": str(tp2),
                        "numero_sorteo": ns2,
                        "id_sorteo": f"{tp2}-{ns2}",
                        "clave_edicion_producto": _first(g, "clave_edicion_producto"),
                        "boletos_en_semana_cierre_objetivo": c,
                        "boletos_fuera_semana_cierre_objetivo": o,
                    }
                )
            total = closing_total + outside_total
            if not bought:
                label = (
                    ("PERDIDO_A_OTRO_EN_CIERRE" if closing_total > 0 else "PERDIDO_A_OTRO_FUERA_CIERRE")
                    if total > 0
                    else "CHURN_TOTAL"
                )
            else:
                label = "RETENIDO_Y_OTROS" if total > 0 else "RETENIDO"
            out.append(
                {
                    "ventana_numero": vn,
                    "clave_persona": persona,
                    "tipo_producto": tipo,
                    "numero_sorteo_ultima": ns,
                    "clave_edicion_producto_ultima": w["clave_edicion_producto"],
                    "ultima_fecha_inicio": ini.date() if ini else None,
                    "ultima_fecha_fin": fin.date() if fin else None,
                    "ultima_semana_cierre_ini": (fin - closing_days * DAY).date() if fin else None,
                    "ultima_semana_cierre_fin": fin.date() if fin else None,
                    "hist_boletos_pre_cierre": tickets([r for r in hist if r["en_pre_cierre"]]),
                    "hist_boletos_semana_cierre": tickets([r for r in hist if r["en_semana_cierre"]]),
                    "hist_ediciones_distintas": len({r["numero_sorteo"] for r in hist}),
                    "ultima_boletos_pre_cierre": last_pre,
                    "ultima_boletos_semana_cierre": last_closing,
                    "compro_ultima_edicion": bought,
                    "otros_boletos_en_semana_cierre_del_producto": closing_total,
                    "otros_boletos_fuera_semana_cierre_del_producto": outside_total,
                    "otros_tipos_producto_distintos": len({d["tipo_producto"] for d in other_detail}),
                    "canibalizacion_clase": label,
                    "hist_detalle_por_edicion_json": json.dumps(hist_detail, separators=(",", ":")),
                    "otros_detalle_en_ventana_ultima_json": json.dumps(other_detail, separators=(",", ":")),
                }
            )
    return out


def single_window(purchases, editions, closing_days=7):
    """One window per type: its highest-numbered edition, no date limits."""
    by_key = {e["clave_edicion_producto"]: e for e in editions}
    enr = []
    for p in purchases:
        e = by_key.get(p["clave_edicion_producto"])
        t = p["fecha_rotulacion_finalizacion"]
        if e is None or t is None or e["tipo_producto"] is None or e["numero_sorteo"] is None:
            continue
        closing_start = e["fecha_fin"] - closing_days * DAY if e["fecha_fin"] else None
        row = dict(p)
        row.update(
            tipo_producto=e["tipo_producto"],
            numero_sorteo=e["numero_sorteo"],
            fecha_inicio=e["fecha_inicio"],
            fecha_fin=e["fecha_fin"],
            en_semana_cierre=closing_start is not None and closing_start <= t <= e["fecha_fin"],
            en_pre_cierre=e["fecha_inicio"] is not None
            and closing_start is not None
            and e["fecha_inicio"] <= t < closing_start,
        )
        enr.append(row)
    wins = {}
    for tp in {e["tipo_producto"] for e in editions if e["tipo_producto"] is not None}:
        eds = sorted(
            (e for e in editions if e["tipo_producto"] == tp),
            key=lambda e: (e["numero_sorteo"] is None, -(e["numero_sorteo"] or 0), e["clave_edicion_producto"]),
        )

        def first_set(col):
            return next((e[col] for e in eds if e[col] is not None), None)

        numbers = [e["numero_sorteo"] for e in eds if e["numero_sorteo"] is not None]
        wins[tp] = [
            (
                0,
                {
                    "numero_sorteo": max(numbers) if numbers else None,
                    "clave_edicion_producto": first_set("clave_edicion_producto"),
                    "fecha_inicio": first_set("fecha_inicio"),
                    "fecha_fin": first_set("fecha_fin"),
                },
            )
        ]
    rows = _rows(enr, wins, closing_days)
    for r in rows:
        del r["ventana_numero"]
        r["tipo_producto"] = float(r["tipo_producto"])
    return rows
