"""What a customer bought of *other* product types while a window's edition was on sale.

This is an interval join (purchase time inside ``[ini, fin]`` of a window of another
type). Instead of a self join of purchases on the customer, the windows -- an
edition-sized table -- are expanded to time buckets and broadcast (see
``switching.role_rows``); each purchase then meets only the few windows whose span
covers its bucket, with the exact bounds tested afterwards. The bucket width is chosen
from the windows' total span so the expanded table stays under a fixed row bound (one
day when that fits).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edflux.constants import CLOSING_DAYS
from edflux.functions.dates import minus_days
from edflux.functions.json import json_record, json_text
from edflux.functions.labels import sorteo_id


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _epoch_day() -> Column:
    return F.lit("1970-01-01").cast("date")

MAX_BUCKET_ROWS = 1_000_000

TARGET = ["clave_persona", "objetivo_tipo", "objetivo_ventana"]


def bucket_of(t: Column, width_days: int) -> Column:
    day = F.datediff(t.cast("date"), _epoch_day()).cast("bigint")
    return day if width_days == 1 else F.floor(day / F.lit(width_days)).cast("bigint")


@dataclass(frozen=True)
class WindowSpan:
    """Size facts of a windows table: bucket width, window count, earliest start, latest end."""

    width_days: int
    n_windows: int
    lo: datetime | None
    hi: datetime | None
    fits: bool = True  # the bucket lookup stays under the row bound (broadcastable)


def window_span(windows: DataFrame, max_rows: int = MAX_BUCKET_ROWS) -> WindowSpan:
    """Pick the bucket width that keeps the expanded windows under ``max_rows``.

    One small aggregate over the windows table (edition-sized).
    """
    ini, fin = F.col("ultima_fecha_inicio"), F.col("ultima_fecha_fin")
    valid = fin >= ini
    span = F.when(valid, F.datediff(fin.cast("date"), ini.cast("date")) + 1)
    row = windows.agg(
        F.coalesce(F.sum(span), F.lit(0)).alias("days"),
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(valid, ini)).alias("lo"),
        F.max(F.when(valid, fin)).alias("hi"),
    ).collect()[0]  # a global aggregate: one row, one job (``first()`` would run several)
    days, n = int(row["days"]), int(row["n"])
    if n == 0 or days + n <= max_rows:
        width = 1
    else:
        width = max(1, math.ceil(days / max(max_rows - 2 * n, 1)))
    # Each window touches at most days/width + 2 buckets, plus one sentinel per bucket.
    fits = 2 * (math.ceil(days / width) + 2 * n) <= 2 * max_rows and 4 * n <= max_rows
    return WindowSpan(width, n, row["lo"], row["hi"], fits)


def bucketed_windows(windows: DataFrame, width_days: int, closing_days: int = CLOSING_DAYS) -> DataFrame:
    """One row per (window, bucket the window's span touches); null or reversed spans give none."""
    ini, fin = F.col("ultima_fecha_inicio"), F.col("ultima_fecha_fin")
    buckets = F.when(fin >= ini, F.sequence(bucket_of(ini, width_days), bucket_of(fin, width_days)))
    return windows.select(
        F.col("tipo_producto").alias("objetivo_tipo"),
        F.col("ventana_numero").alias("objetivo_ventana"),
        ini.alias("w_ini"),
        fin.alias("w_fin"),
        minus_days(fin, closing_days).alias("w_cierre_ini"),
        F.explode(buckets).alias("bucket"),
    )


def other_record_json(tp2: Column, ns2: Column, cep2: Column, closing: Column, outside: Column) -> Column:
    """One other-product record as JSON text (field order is part of the output)."""
    return json_record(
        tipo_producto=json_text(tp2),
        numero_sorteo=ns2,
        id_sorteo=json_text(sorteo_id(tp2, ns2)),
        clave_edicion_producto=cep2,
        boletos_en_semana_cierre_objetivo=closing,
        boletos_fuera_semana_cierre_objetivo=outside,
    )


def run_index(od: Column) -> dict[str, Column]:
    """Per pair, once: the windows in ``od`` (sorted by window) and where the run of each begins.

    ``od_first`` has one entry more, behind the last run.
    """
    w = od["w"]
    return {
        "od_w": F.array_distinct(w),
        "od_first": F.array_append(F.transform(F.array_distinct(w), lambda x: F.array_position(w, x).cast("int")), F.size(od) + 1),
    }


def record_texts(od: Column) -> dict[str, Column]:
    """Per pair, once: the JSON text of each entry of ``od``."""
    return {"od_json": F.transform(od, lambda x: other_record_json(x["tp2"], x["ns2"], x["cep2"], x["en_cierre"], x["fuera_cierre"]))}


def window_run(window_number: Column) -> dict[str, Column]:
    """``mine`` and ``mine_json``: the entries of a window (``ventana_numero``), slices of the pair's ``od`` and ``od_json``."""
    at = F.array_position(F.col("od_w"), window_number).cast("int")
    first = F.get(F.col("od_first"), at - 1)

    def run(entries: Column) -> Column:
        return F.when(at > 0, F.slice(entries, first, F.get(F.col("od_first"), at) - first)).otherwise(F.slice(entries, 1, 0))

    return {"mine": run(F.col("od")), "mine_json": run(F.col("od_json"))}


def other_columns(mine: Column, texts: Column) -> dict[str, Column]:
    """Other-product columns of one spine row from its :func:`window_run`.

    The entries come out in the list order (type, number); their JSON records were written once
    per pair and are only joined here. ``otros_detail`` is the same list typed, for
    consumers that read fields (the flow).
    """
    some = F.size(mine) > 0  # most rows have none: nothing to walk through
    closing = F.when(some, F.aggregate(mine, _zero(), lambda acc, x: acc + x["en_cierre"])).otherwise(_zero())
    outside = F.when(some, F.aggregate(mine, _zero(), lambda acc, x: acc + x["fuera_cierre"])).otherwise(_zero())
    detail = F.transform(
        mine,
        lambda x: F.struct(
            x["tp2"].cast("string").alias("tipo_producto"),
            x["ns2"].alias("numero_sorteo"),
            sorteo_id(x["tp2"], x["ns2"]).alias("id_sorteo"),
            x["cep2"].alias("clave_edicion_producto"),
            x["en_cierre"].alias("boletos_en_semana_cierre_objetivo"),
            x["fuera_cierre"].alias("boletos_fuera_semana_cierre_objetivo"),
        ),
    )
    return {
        "otros_boletos_en_semana_cierre_del_producto": closing,
        "otros_boletos_fuera_semana_cierre_del_producto": outside,
        "otros_tipos_producto_distintos": F.size(F.array_distinct(mine["tp2"])).cast("bigint"),
        "otros_detalle_en_ventana_ultima_json": F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")),
        "otros_detail": detail,
    }
