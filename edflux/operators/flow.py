"""Origin-to-destination flow of customers lost to another product in the closing week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edflux.constants import CLASS_LOST_CLOSING
from edflux.functions.labels import edition_tag
from edflux.plans.broadcast import bounded_broadcast
from edflux.schemas import OTHER_DETAIL


def lost_destinations(rollup: DataFrame, lost_class: str = CLASS_LOST_CLOSING) -> DataFrame:
    """(customer, origin edition, destination edition) for every destination bought in the
    target's closing week by a customer classed ``lost_class``; empty lists give no row.

    ``rollup`` is either a stored rollup (detail list as JSON text, parsed here) or the
    typed rows of ``SwitchingCore.rows`` (column ``otros_detail``), which skips the text
    round trip and lets Catalyst prune every column the flow does not use.
    """
    if "otros_detail" in rollup.columns:
        details = F.col("otros_detail")
    else:
        text = F.col("otros_detalle_en_ventana_ultima_json")
        parsed = F.from_json(text, T.ArrayType(OTHER_DETAIL))
        broken = F.raise_error(F.concat(F.lit("detail list is no JSON: "), F.substring(text, 1, 200)))
        details = F.when(text.isNotNull() & parsed.isNull(), broken.cast(T.ArrayType(OTHER_DETAIL))).otherwise(parsed)
    return (
        rollup.where(F.col("canibalizacion_clase") == F.lit(lost_class))
        .select(
            "clave_persona",
            F.col("clave_edicion_producto_ultima").alias("producto_origen_id"),
            F.explode(details).alias("d"),
        )
        .where(F.col("d.boletos_en_semana_cierre_objetivo") > 0)
        .select(
            "clave_persona",
            "producto_origen_id",
            F.col("d.clave_edicion_producto").cast("bigint").alias("producto_destino_id"),
        )
    )


def migration_flow(rollup: DataFrame, editions: DataFrame, lost_class: str = CLASS_LOST_CLOSING) -> DataFrame:
    """Distinct lost customers per (origin edition, origin tag, destination edition, tag).

    Customers are counted distinct per edition pair first (the distinct count shuffles
    on the customer as well, so a crowded pair is spread out); tags are attached to the
    small result afterwards. Joining distinct (key, tag) rows gives the same groups as
    tagging every row first, also when a key has several tags. Sorted by origin tag
    (nulls first), then customers descending.
    """
    counts = (
        lost_destinations(rollup, lost_class)
        .groupBy("producto_origen_id", "producto_destino_id")
        .agg(F.count_distinct("clave_persona").alias("clientes_perdidos"))
    )
    tags = bounded_broadcast(
        editions.select(
            "clave_edicion_producto",
            edition_tag(F.col("desc_corta_sorteo"), F.col("numero_sorteo")).alias("tag"),
        ).distinct()
    )
    dest = tags.select(
        F.col("clave_edicion_producto").alias("producto_destino_id"),
        F.col("tag").alias("producto_destino_tag"),
    )
    orig = tags.select(
        F.col("clave_edicion_producto").alias("producto_origen_id"),
        F.col("tag").alias("producto_origen_tag"),
    )
    return (
        counts.join(dest, "producto_destino_id", "left")
        .join(orig, "producto_origen_id", "left")
        .select(
            "producto_origen_id",
            "producto_origen_tag",
            "producto_destino_id",
            "producto_destino_tag",
            F.col("clientes_perdidos").cast("bigint").alias("clientes_perdidos"),
        )
        .orderBy(F.col("producto_origen_tag").asc_nulls_first(), F.col("clientes_perdidos").desc())
    )
