"""Text extracts with unreadable values: the readable rows, and a row for each value that isn't.

The strict readers fail the job at the first such value. Here each text column that must be a
number (and, for editions, a time) is tested without failing; a row with a problem is left out of the typed
rows and told in the rejects, so that nothing is dropped in silence. Both results are
projections of one scan, without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edflux.functions.casts import blank_to_null, number_problem
from edflux.operators.prepare import clean_editions, clean_purchases


def _time_problem(c: Column) -> Column:
    text = blank_to_null(c)
    return F.when(text.isNotNull() & F.try_to_timestamp(text).isNull(), "not a time")


PURCHASE_RULES = {name: lambda c: number_problem(c, "bigint") for name in ("clave_detalle_compra", "clave_persona", "clave_edicion_producto", "numero_boleto")}
EDITION_RULES = {
    "clave_edicion_producto": lambda c: number_problem(c, "bigint", whole=True),
    "tipo_producto": lambda c: number_problem(c, "int"),
    "numero_sorteo": lambda c: number_problem(c, "int"),
    "fecha_inicio": _time_problem,
    "fecha_fin": _time_problem,
    "fecha_celebracion": _time_problem,
}


def _reasons(raw: DataFrame, rules: dict) -> dict[str, Column]:
    """For each text column with a rule: why its value can't be read, or null."""
    return {name: rule(F.col(name)) for name, rule in rules.items() if name in raw.columns and isinstance(raw.schema[name].dataType, T.StringType)}


def problems(raw: DataFrame, rules: dict) -> Column:
    """columna, valor and motivo of each text value of a row that its rule can't read."""
    each = []
    for name, why in _reasons(raw, rules).items():
        each.append(F.when(why.isNotNull(), F.struct(F.lit(name).alias("columna"), F.col(name).alias("valor"), why.alias("motivo"))))
    none = F.array().cast("array<struct<columna:string,valor:string,motivo:string>>")
    return F.filter(F.array(*each), lambda x: x.isNotNull()) if each else none


def _parted(raw: DataFrame, rules: dict, key: str) -> tuple[DataFrame, DataFrame]:
    found = problems(raw, rules)
    told = raw.select(F.col(key).cast("string").alias(key), F.to_json(F.struct(*(F.col(f"`{c}`") for c in raw.columns))).alias("fila"), F.explode(found).alias("x"))
    readable = reduce(lambda a, b: a & b, (why.isNull() for why in _reasons(raw, rules).values()), F.lit(True))
    return raw.where(readable), told.select(key, "x.*", "fila")


def tolerant_purchases(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed purchases of the readable rows, and (clave_detalle_compra, columna, valor, motivo, fila) of the rest.

    Purchase times that can't be read stay null, as in the strict reader; ``fila`` is the row as JSON.
    """
    kept, told = _parted(raw, PURCHASE_RULES, "clave_detalle_compra")
    return clean_purchases(kept), told


def tolerant_editions(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As :func:`tolerant_purchases` for editions; their times must be readable too."""
    kept, told = _parted(raw, EDITION_RULES, "clave_edicion_producto")
    return clean_editions(kept), told
