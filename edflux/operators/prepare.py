"""Typed purchases and editions, the recent-edition cut, enrichment and purchase flags.

All functions are ``DataFrame -> DataFrame`` and lazy, except that joins with the
edition dimension broadcast it only after checking its size.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edflux.constants import CLOSING_DAYS, FLAG_CLOSING, FLAG_NONE, FLAG_PRE, LOOKBACK_DAYS
from edflux.functions.casts import lenient_int, lenient_long, strict_long
from edflux.functions.dates import (
    as_timestamp_ntz,
    days_before,
    minus_days,
    normalize_as_of,
    parse_purchase_time,
    parse_strict_timestamp,
)
from edflux.functions.labels import item_completo
from edflux.plans.broadcast import bounded_broadcast
from edflux.plans.pruning import near_keys

# --------------------------------------------------------------------------- casts


def _typed(df: DataFrame, name: str, text_rule, other_type: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast(other_type).alias(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return text_rule(F.col(name)).cast(other_type).alias(name)
    return F.col(name).cast(other_type).alias(name)


def _timestamp(df: DataFrame, name: str, text_rule) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("timestamp_ntz").alias(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return text_rule(F.col(name)).alias(name)
    # An instant keeps its wall-clock reading in the session zone (UTC).
    return F.col(name).cast("timestamp_ntz").alias(name)


def _text(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("string").alias(name)
    return F.col(name).cast("string").alias(name)


def clean_purchases(df: DataFrame) -> DataFrame:
    """Purchases with the types of ``schemas.PURCHASES``; text input is parsed.

    Purchase time text accepts ``yyyy-MM-dd HH:mm:ss[.f]`` only, anything else is null.
    Ticket numbers written as ``"00123"`` or ``"123.0"`` read as 123.
    """
    return df.select(
        _typed(df, "clave_detalle_compra", lenient_long, "bigint"),
        _text(df, "agrupador_interno_compra"),
        _typed(df, "clave_persona", lenient_long, "bigint"),
        _text(df, "clave_rotulo"),
        _typed(df, "clave_edicion_producto", lenient_long, "bigint"),
        _timestamp(df, "fecha_rotulacion_finalizacion", parse_purchase_time),
        _text(df, "clave_boleto_unico"),
        _text(df, "clave_boleto_intranet"),
        _typed(df, "numero_boleto", lenient_long, "bigint"),
    )


def clean_editions(df: DataFrame, strict: bool = False) -> DataFrame:
    """Editions with the types of ``schemas.EDITIONS``.

    The key must be integer text (``"1.0"`` fails the job); type and number may be
    ``"1.0"`` or blank (null); dates must parse or be blank. With ``strict`` a null key
    fails the job too.
    """
    if strict and "clave_edicion_producto" in df.columns:
        df = df.where(
            F.when(F.col("clave_edicion_producto").isNotNull(), F.lit(True)).otherwise(
                F.raise_error(F.lit("edition without clave_edicion_producto"))
            )
        )
    return df.select(
        _typed(df, "clave_edicion_producto", strict_long, "bigint"),
        _typed(df, "tipo_producto", lenient_int, "int"),
        _typed(df, "numero_sorteo", lenient_int, "int"),
        _text(df, "desc_sorteo"),
        _text(df, "desc_corta_sorteo"),
        _timestamp(df, "fecha_inicio", parse_strict_timestamp),
        _timestamp(df, "fecha_fin", parse_strict_timestamp),
        _timestamp(df, "fecha_celebracion", parse_strict_timestamp),
    )


# ------------------------------------------------------------------ editions


def dedup_editions(editions: DataFrame) -> DataFrame:
    """One row per edition key, chosen deterministically (latest end, then highest number).

    A plain ``dropDuplicates`` would keep an arbitrary row.
    """
    w = Window.partitionBy("clave_edicion_producto").orderBy(
        F.col("fecha_fin").desc_nulls_last(),
        F.col("numero_sorteo").desc_nulls_last(),
        F.col("tipo_producto").asc_nulls_last(),
        F.col("fecha_inicio").desc_nulls_last(),
        F.col("desc_sorteo").asc_nulls_last(),
        F.col("desc_corta_sorteo").asc_nulls_last(),
        F.col("fecha_celebracion").desc_nulls_last(),
    )
    return (
        editions.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )


def editions_recent(
    editions: DataFrame, as_of: datetime | str, lookback_days: int = LOOKBACK_DAYS, dedup: bool = True
) -> DataFrame:
    """Editions that ended strictly inside ``(as_of - lookback, as_of)``; null ends drop.

    The bounds are literals, so the filter reaches the parquet scan of ``fecha_fin``.
    Duplicated keys are resolved after the cut (``dedup``), as the enrichment does.
    """
    as_of = normalize_as_of(as_of)
    lo = days_before(as_of, lookback_days)
    recent = editions.where(
        (F.col("fecha_fin") < as_timestamp_ntz(as_of)) & (F.col("fecha_fin") > as_timestamp_ntz(lo))
    )
    return dedup_editions(recent) if dedup else recent


def edition_labels(editions: DataFrame) -> DataFrame:
    """``item_completo = desc_sorteo + ' ' + numero_sorteo`` per edition."""
    return editions.select(
        "clave_edicion_producto",
        item_completo(F.col("desc_sorteo"), F.col("numero_sorteo")).alias("item_completo"),
    )


# ----------------------------------------------------------------- purchases


def _recent_side(recent: DataFrame) -> DataFrame:
    """``recent`` under a predicate that all its rows meet (each has an end).

    With a selective predicate on the broadcast side, Spark prunes the partitions of a purchase
    table partitioned by edition at run time; without that layout it costs nothing.
    """
    return recent.where(F.col("fecha_fin") > F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))


def purchases_recent(purchases: DataFrame, recent: DataFrame) -> DataFrame:
    """Purchases of recent editions: a semi join on the edition key, broadcast after a size check."""
    keys = bounded_broadcast(_recent_side(recent).select("clave_edicion_producto"))
    return near_keys(purchases, recent, "clave_edicion_producto").join(keys, "clave_edicion_producto", "left_semi")


_EDITION_ATTRS = [
    "clave_edicion_producto",
    "tipo_producto",
    "numero_sorteo",
    "desc_sorteo",
    "fecha_inicio",
    "fecha_fin",
    "fecha_celebracion",
]


def purchases_enriched(
    purchases: DataFrame,
    editions: DataFrame,
    prune_scan: bool = False,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Purchases with their edition's attributes; rows without time, type or number drop.

    ``editions`` must hold one row per key (see :func:`dedup_editions`); it is
    broadcast after a size check, so the fact side never shuffles here. ``prune_scan``
    says that they are the recent ones, all with an end (see :func:`_recent_side`): their keys
    then bound the fact scan (see :mod:`edflux.plans.pruning`). ``watch`` is applied to the matched rows
    before any drop.
    """
    dim = bounded_broadcast((_recent_side(editions) if prune_scan else editions).select(*_EDITION_ATTRS))
    facts = near_keys(purchases, editions, "clave_edicion_producto") if prune_scan else purchases
    matched = facts.join(dim, "clave_edicion_producto", "inner")
    return (watch(matched) if watch else matched).where(
        F.col("fecha_rotulacion_finalizacion").isNotNull()
        & F.col("tipo_producto").isNotNull()
        & F.col("numero_sorteo").isNotNull()
    )


def closing_start(fin: Column, closing_days: int = CLOSING_DAYS) -> Column:
    return minus_days(fin, closing_days)


def purchases_flagged(enriched: DataFrame, closing_days: int = CLOSING_DAYS) -> DataFrame:
    """Adds ``semana_cierre_ini``, ``en_semana_cierre``, ``en_pre_cierre`` and a flag code.

    Closing week: ``fin - 7d <= t <= fin``; pre-closing: ``ini <= t < fin - 7d``. The two
    are disjoint and both are false for a purchase before ``ini`` or after ``fin``.
    """
    t = F.col("fecha_rotulacion_finalizacion")
    sci = closing_start(F.col("fecha_fin"), closing_days)
    closing = F.coalesce((t >= sci) & (t <= F.col("fecha_fin")), F.lit(False))
    pre = F.coalesce((t >= F.col("fecha_inicio")) & (t < sci), F.lit(False))
    return (
        enriched.withColumn("semana_cierre_ini", sci)
        .withColumn("en_semana_cierre", closing)
        .withColumn("en_pre_cierre", pre)
        .withColumn(
            "flag",
            F.when(closing, F.lit(FLAG_CLOSING)).when(pre, F.lit(FLAG_PRE)).otherwise(F.lit(FLAG_NONE)),
        )
    )
