"""Building small typed DataFrames from dict rows and comparing results."""

from __future__ import annotations

from datetime import datetime

from edflux.schemas import EDITIONS, PURCHASES

KEYS = ["clave_persona", "tipo_producto", "ventana_numero"]


def purchases_df(spark, rows):
    cols = [f.name for f in PURCHASES.fields]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], PURCHASES)


def editions_df(spark, rows):
    cols = [f.name for f in EDITIONS.fields]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], EDITIONS)


def edition(key, tipo, numero, ini, fin, desc=None, short=None):
    return {
        "clave_edicion_producto": key,
        "tipo_producto": tipo,
        "numero_sorteo": numero,
        "desc_sorteo": desc if desc is not None else f"SORTEO {tipo}",
        "desc_corta_sorteo": short if short is not None else f"S{tipo}",
        "fecha_inicio": ini,
        "fecha_fin": fin,
    }


_seq = iter(range(1, 10**9))


def purchase(persona, key, t, boleto=None, cdc=None):
    return {
        "clave_detalle_compra": cdc if cdc is not None else next(_seq),
        "clave_persona": persona,
        "clave_edicion_producto": key,
        "fecha_rotulacion_finalizacion": t,
        "numero_boleto": boleto,
    }


def dicts(df):
    return [r.asDict() for r in df.collect()]


def by_keys(rows, keys=KEYS):
    return sorted(rows, key=lambda r: tuple((r[k] is None, r[k]) for k in keys if k in r))


def d(s: str) -> datetime:
    return datetime.fromisoformat(s)
