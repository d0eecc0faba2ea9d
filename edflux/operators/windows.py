"""Edition windows per product type, the latest edition per type, and the spine."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edflux.constants import WINDOW_DAYS
from edflux.functions.dates import as_timestamp_ntz, days_before, midnight, normalize_as_of
from edflux.plans.broadcast import DEFAULT_MAX_BROADCAST_ROWS, is_bounded, salted_join

WINDOW_COLUMNS = [
    "tipo_producto",
    "ventana_numero",
    "numero_sorteo_ultima",
    "clave_edicion_producto_ultima",
    "ultima_fecha_inicio",
    "ultima_fecha_fin",
]


def drop_untyped_editions(editions: DataFrame, strict: bool = False) -> DataFrame:
    """Editions without key, type or number cannot be windows; drop them, or fail if ``strict``."""
    ok = (
        F.col("clave_edicion_producto").isNotNull()
        & F.col("tipo_producto").isNotNull()
        & F.col("numero_sorteo").isNotNull()
    )
    if strict:
        return editions.where(
            F.when(ok, F.lit(True)).otherwise(
                F.raise_error(F.lit("edition without clave_edicion_producto, tipo_producto or numero_sorteo"))
            )
        )
    return editions.where(ok)


def edition_windows(
    recent: DataFrame, as_of: datetime | str, window_days: int = WINDOW_DAYS, strict: bool = False
) -> DataFrame:
    """Number the recent editions of each type 0, -1, -2, ... by descending number.

    Walking down the numbers of a type: stop at the first edition that ended before
    ``midnight(as_of) - window_days`` (later lower numbers are not looked at even if they
    ended later); skip editions that ended after midnight (they take no number).
    Ties in the number are ordered by the edition key.
    """
    as_of = normalize_as_of(as_of)
    today = midnight(as_of)
    cutoff = days_before(today, window_days)
    eds = drop_untyped_editions(recent, strict).select(
        "tipo_producto", "numero_sorteo", "clave_edicion_producto", "fecha_inicio", "fecha_fin"
    )
    order = Window.partitionBy("tipo_producto").orderBy(
        F.col("numero_sorteo").desc(), F.col("clave_edicion_producto").asc()
    )
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stopped = F.max(F.when(F.col("fecha_fin") < as_timestamp_ntz(cutoff), 1).otherwise(0)).over(running)
    kept = (
        eds.withColumn("_stopped", stopped)
        .where((F.col("_stopped") == 0) & (F.col("fecha_fin") <= as_timestamp_ntz(today)))
        .drop("_stopped")
    )
    return kept.select(
        F.col("tipo_producto"),
        (F.lit(1) - F.row_number().over(order)).cast("int").alias("ventana_numero"),
        F.col("numero_sorteo").alias("numero_sorteo_ultima"),
        F.col("clave_edicion_producto").alias("clave_edicion_producto_ultima"),
        F.col("fecha_inicio").alias("ultima_fecha_inicio"),
        F.col("fecha_fin").alias("ultima_fecha_fin"),
    )


def last_edition(editions: DataFrame) -> DataFrame:
    """Latest edition per type, each column taken from the highest-numbered row where it is set.

    Rows are ranked by number descending (unnumbered rows last, ties by key, then by the
    latest end and start: repeated editions); for every column the first non-null value in that order is kept, so columns may come from
    different rows. Rows without a type are ignored.
    """
    eds = editions.where(F.col("tipo_producto").isNotNull())
    rank = F.struct(
        F.col("numero_sorteo").isNotNull().alias("has_number"),
        F.coalesce(F.col("numero_sorteo"), F.lit(0)).alias("numero"),
        (-F.col("clave_edicion_producto")).alias("neg_key"),
        "fecha_fin",
        "fecha_inicio",
    )

    def first_set(name: str):
        return F.max_by(F.col(name), F.when(F.col(name).isNotNull(), rank))

    return eds.groupBy("tipo_producto").agg(
        F.max("numero_sorteo").alias("numero_sorteo_ultima"),
        first_set("clave_edicion_producto").alias("clave_edicion_producto_ultima"),
        first_set("fecha_inicio").alias("ultima_fecha_inicio"),
        first_set("fecha_fin").alias("ultima_fecha_fin"),
    )


def window_spine(pairs: DataFrame, windows: DataFrame, small: bool | None = None) -> DataFrame:
    """Every (customer, type) pair times every window of its type; types without windows drop.

    ``windows`` is edition-sized and broadcast, so the pair side never shuffles; ``small``
    says whether its row bound holds (checked here when not given). Beyond the bound a
    salted shuffle join spreads each product type over many tasks.
    """
    if small is None:
        small = is_bounded(windows, DEFAULT_MAX_BROADCAST_ROWS)
    if small:
        return pairs.join(F.broadcast(windows), "tipo_producto", "inner")
    return salted_join(pairs, windows, "tipo_producto", "clave_persona")
