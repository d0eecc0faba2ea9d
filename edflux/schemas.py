"""Fixed StructTypes for every table the library reads or writes (never inferSchema)."""

from pyspark.sql import types as T

# Fact: one row per purchased ticket line.
PURCHASE_COLUMNS = [
    "clave_detalle_compra",
    "agrupador_interno_compra",
    "clave_persona",
    "clave_rotulo",
    "clave_edicion_producto",
    "fecha_rotulacion_finalizacion",
    "clave_boleto_unico",
    "clave_boleto_intranet",
    "numero_boleto",
]

PURCHASES = T.StructType(
    [
        T.StructField("clave_detalle_compra", T.LongType()),
        T.StructField("agrupador_interno_compra", T.StringType()),
        T.StructField("clave_persona", T.LongType()),
        T.StructField("clave_rotulo", T.StringType()),
        T.StructField("clave_edicion_producto", T.LongType()),
        T.StructField("fecha_rotulacion_finalizacion", T.TimestampNTZType()),
        T.StructField("clave_boleto_unico", T.StringType()),
        T.StructField("clave_boleto_intranet", T.StringType()),
        T.StructField("numero_boleto", T.LongType()),
    ]
)

EDITION_COLUMNS = [
    "clave_edicion_producto",
    "tipo_producto",
    "numero_sorteo",
    "desc_sorteo",
    "desc_corta_sorteo",
    "fecha_inicio",
    "fecha_fin",
    "fecha_celebracion",
]

EDITIONS = T.StructType(
    [
        T.StructField("clave_edicion_producto", T.LongType()),
        T.StructField("tipo_producto", T.IntegerType()),
        T.StructField("numero_sorteo", T.IntegerType()),
        T.StructField("desc_sorteo", T.StringType()),
        T.StructField("desc_corta_sorteo", T.StringType()),
        T.StructField("fecha_inicio", T.TimestampNTZType()),
        T.StructField("fecha_fin", T.TimestampNTZType()),
        T.StructField("fecha_celebracion", T.TimestampNTZType()),
    ]
)

EDITIONS_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in EDITION_COLUMNS])

# Nested records of the rollup (field order is part of the JSON text).
OTHER_DETAIL = T.StructType(
    [
        T.StructField("tipo_producto", T.StringType()),
        T.StructField("numero_sorteo", T.IntegerType()),
        T.StructField("id_sorteo", T.StringType()),
        T.StructField("clave_edicion_producto", T.LongType()),
        T.StructField("boletos_en_semana_cierre_objetivo", T.LongType()),
        T.StructField("boletos_fuera_semana_cierre_objetivo", T.LongType()),
    ]
)

ROLLUP = T.StructType(
    [
        T.StructField("ventana_numero", T.IntegerType()),
        T.StructField("clave_persona", T.LongType()),
        T.StructField("tipo_producto", T.IntegerType()),
        T.StructField("numero_sorteo_ultima", T.IntegerType()),
        T.StructField("clave_edicion_producto_ultima", T.LongType()),
        T.StructField("ultima_fecha_inicio", T.DateType()),
        T.StructField("ultima_fecha_fin", T.DateType()),
        T.StructField("ultima_semana_cierre_ini", T.DateType()),
        T.StructField("ultima_semana_cierre_fin", T.DateType()),
        T.StructField("hist_boletos_pre_cierre", T.LongType()),
        T.StructField("hist_boletos_semana_cierre", T.LongType()),
        T.StructField("hist_ediciones_distintas", T.LongType()),
        T.StructField("ultima_boletos_pre_cierre", T.LongType()),
        T.StructField("ultima_boletos_semana_cierre", T.LongType()),
        T.StructField("compro_ultima_edicion", T.BooleanType()),
        T.StructField("otros_boletos_en_semana_cierre_del_producto", T.LongType()),
        T.StructField("otros_boletos_fuera_semana_cierre_del_producto", T.LongType()),
        T.StructField("otros_tipos_producto_distintos", T.LongType()),
        T.StructField("canibalizacion_clase", T.StringType()),
        T.StructField("hist_detalle_por_edicion_json", T.StringType()),
        T.StructField("otros_detalle_en_ventana_ultima_json", T.StringType()),
    ]
)

ROLLUP_COLUMNS = [f.name for f in ROLLUP.fields]

