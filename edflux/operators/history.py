"""A customer's own purchases of a product type, as of each window.

Distinct tickets over "all editions numbered below the window" are a running distinct
count, which Spark cannot evaluate as ``COUNT(DISTINCT) OVER``. A ticket counts below
window ``w`` exactly when its *first* edition (lowest number, per flag) is below ``w``,
so per edition we keep how many tickets appear there for the first time; the running
distinct count is then a prefix sum over a per-(customer, type) array whose length is
bounded by the number of recent editions of the type, not by the number of tickets.

The aggregation chain that builds the array lives in ``switching`` (shared with the
other-product measures); this module turns the array into the per-window columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from edflux.functions.dates import day_text
from edflux.functions.json import json_record, json_text
from edflux.functions.labels import sorteo_id
from edflux.functions.tickets import ticket_count


def _zero() -> Column:
    return F.lit(0).cast("bigint")


_CUM = "struct<new_pre:bigint,pre_rows:bigint,new_closing:bigint,closing_rows:bigint>"


def pair_prefix(ed: Column, tipo: Column) -> dict[str, Column]:
    """Per (customer, type), computed once: the arrays each window row reads by position.

    ``ed`` is sorted by number. ``ed_ns`` holds the numbers, ``ed_cum`` running totals of
    new tickets and rows per flag (so a window's history is one element lookup),
    ``ed_last`` the per-edition ticket counts and ``ed_json`` each edition's record as
    JSON text (a window's list is a slice of it, byte-identical to ``to_json``).
    """
    zero = F.lit(0).cast("bigint")
    start = F.struct(
        F.array().cast(f"array<{_CUM}>").alias("a"),
        F.struct(
            zero.alias("new_pre"), zero.alias("pre_rows"), zero.alias("new_closing"), zero.alias("closing_rows")
        ).alias("s"),
    )

    def step(acc, x):
        s = F.struct(
            (acc["s"]["new_pre"] + x["new_pre"]).alias("new_pre"),
            (acc["s"]["pre_rows"] + x["pre_rows"]).alias("pre_rows"),
            (acc["s"]["new_closing"] + x["new_closing"]).alias("new_closing"),
            (acc["s"]["closing_rows"] + x["closing_rows"]).alias("closing_rows"),
        )
        return F.struct(F.array_append(acc["a"], s).alias("a"), s.alias("s"))

    record = lambda x: json_record(
        numero_sorteo=x["ns"],
        tipo_producto=json_text(tipo),
        id_sorteo=json_text(sorteo_id(tipo, x["ns"])),
        clave_edicion_producto=x["cep"],
        boletos_pre_cierre=x["pre"],
        boletos_semana_cierre=x["closing"],
        fecha_fin_edicion=json_text(day_text(x["fin"])),
    )
    return {
        "ed_ns": F.transform(ed, lambda x: x["ns"]),
        "ed_cum": F.aggregate(ed, start, step, lambda acc: acc["a"]),
        "ed_last": F.transform(ed, lambda x: F.struct(x["pre"].alias("pre"), x["closing"].alias("closing"))),
        "ed_json": F.transform(ed, record),
    }


def own_positions(window_number: Column) -> dict[str, Column]:
    """Where a window stands in its pair's editions: how many are numbered below it, and its own place (or 0)."""
    return {
        "ed_below": F.size(F.filter(F.col("ed_ns"), lambda x: x < window_number)),
        "ed_at": F.array_position(F.col("ed_ns"), window_number).cast("int"),
    }


def own_columns() -> dict[str, Column]:
    """Own-history columns of one spine row from its pair's prefix arrays and :func:`own_positions`.

    History is every edition numbered below the window's number (tickets distinct over
    all of them together); the last edition is the one with the window's number.
    """
    k, pos = F.col("ed_below"), F.col("ed_at")
    cum = F.when(k > 0, F.element_at(F.col("ed_cum"), k))
    last = F.when(pos > 0, F.element_at(F.col("ed_last"), pos))
    last_pre = F.coalesce(last["pre"], _zero())
    last_closing = F.coalesce(last["closing"], _zero())
    return {
        "hist_boletos_pre_cierre": ticket_count(cum["new_pre"], cum["pre_rows"]),
        "hist_boletos_semana_cierre": ticket_count(cum["new_closing"], cum["closing_rows"]),
        "hist_ediciones_distintas": k.cast("bigint"),
        "ultima_boletos_pre_cierre": last_pre,
        "ultima_boletos_semana_cierre": last_closing,
        "compro_ultima_edicion": (last_pre + last_closing) > 0,
        "hist_detalle_por_edicion_json": F.concat(
            F.lit("["), F.array_join(F.slice(F.col("ed_json"), 1, k), ","), F.lit("]")
        ),
    }
