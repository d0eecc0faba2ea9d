"""The driver's TPC-H-like tables mapped onto the purchase and edition schemas.

Purchases are order lines; the product type is the part type; a type's editions are
consecutive periods of ``30 + 10*type`` days from 1995-01-01; a line's edition is
taken 0, 7, 14 or 21 days after the order date; a tenth of the ticket numbers are
null. Editions are derived from the part types present in ``part``.

Fixed values of the mapping (shared with the DuckDB oracle):
part types ECONOMY, LARGE, MEDIUM, PROMO, SMALL, STANDARD map to 1, 2, 3, 4, 5, 6;
epoch 1995-01-01; edition horizon 2500 days; reference instant 2001-08-02 12:00:00.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


FIXTURE_AS_OF = datetime(2001, 8, 2, 12, 0, 0)
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
EPOCH = "1995-01-01"
HORIZON_DAYS = 2500


def _type_code(p_type: Column) -> Column:
    expr = None
    for code, name in enumerate(PART_TYPES, start=1):
        expr = (F.when if expr is None else expr.when)(p_type == F.lit(name), F.lit(code))
    return expr


def _period(tp: Column) -> Column:
    return F.lit(30) + F.lit(10) * tp


# Fixed read schemas of the columns used (no schema inference job per read).
_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_type STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ",
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def fixture_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``detalle_compra`` from lineitem x orders x part (typed, see ``schemas.PURCHASES``)."""
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = _read(spark, sf_dir, "part").select("p_partkey", _type_code(F.col("p_type")).alias("tp"))
    # Join strategies are left to the planner: it broadcasts a side only when its file
    # statistics are under spark.sql.autoBroadcastJoinThreshold, else sort-merge joins. The part comes
    # first: its key is then done with, and fewer columns are shuffled to the orders.
    base = li.join(part, li.l_partkey == part.p_partkey).join(orders, li.l_orderkey == orders.o_orderkey)
    dia = F.datediff(F.col("o_orderdate").cast("date"), F.lit(EPOCH).cast("date")) + F.lit(7) * (
        F.col("l_linenumber") % 4
    )
    # SQL ``DIV`` truncates toward zero. The key is made once a row: as a plain expression it would be
    # repeated in each of the key's range tests, and the stage's method grow too long to be compiled.
    key = F.expr("CAST(tp AS BIGINT) * 1000 + (dia DIV (30 + 10 * tp)) + 1")
    return base.withColumn("dia", dia).withColumn("key", F.explode(F.array(key))).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("clave_detalle_compra"),
        F.lit(None).cast("string").alias("agrupador_interno_compra"),
        F.col("o_custkey").cast("bigint").alias("clave_persona"),
        F.lit(None).cast("string").alias("clave_rotulo"),
        F.col("key").alias("clave_edicion_producto"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("fecha_rotulacion_finalizacion"),
        F.lit(None).cast("string").alias("clave_boleto_unico"),
        F.lit(None).cast("string").alias("clave_boleto_intranet"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit(None))
        .otherwise(F.col("l_suppkey"))
        .cast("bigint")
        .alias("numero_boleto"),
    )


def fixture_editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sorteo``: for every type found in ``part``, numbered editions over the horizon."""
    types = (
        _read(spark, sf_dir, "part")
        .select(_type_code(F.col("p_type")).alias("tp"))
        .where(F.col("tp").isNotNull())
        .distinct()
    )
    n_max = F.expr(f"CAST({HORIZON_DAYS} DIV (30 + 10 * tp) AS INT) + 1")
    eds = types.select("tp", F.explode(F.sequence(F.lit(1), n_max)).alias("n"))
    epoch = F.lit(f"{EPOCH} 00:00:00").cast("timestamp_ntz")
    period = _period(F.col("tp"))
    return eds.select(
        (F.col("tp") * 1000 + F.col("n")).cast("bigint").alias("clave_edicion_producto"),
        F.col("tp").cast("int").alias("tipo_producto"),
        F.col("n").cast("int").alias("numero_sorteo"),
        F.concat(F.lit("SORTEO "), F.col("tp").cast("string")).alias("desc_sorteo"),
        F.concat(F.lit("S"), F.col("tp").cast("string")).alias("desc_corta_sorteo"),
        (epoch + F.make_dt_interval(((F.col("n") - 1) * period).cast("int"))).alias("fecha_inicio"),
        (epoch + F.make_dt_interval((F.col("n") * period - 1).cast("int"))).alias("fecha_fin"),
        F.lit(None).cast("timestamp_ntz").alias("fecha_celebracion"),
    )


def fixture_purchase_time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase times as raw text in several shapes, made from ``events.ts``."""
    ev = _read(spark, sf_dir, "events").select("event_id", "ts")
    r = F.col("event_id") % 6
    ts = F.col("ts")
    text = (
        F.when(r == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(r == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(r == 2, F.date_format(ts, "yyyy-MM-dd"))
        .when(r == 3, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")))
        .when(r == 4, F.lit(""))
    )
    return ev.select("event_id", text.alias("t"))


def fixture_purchases_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchases as a text extract: keys above 2**53, ``"00123"``, ``"123.0"``, blanks, bad times."""
    p = fixture_purchases(spark, sf_dir)
    kind = F.col("clave_detalle_compra") % 5
    person, edition = F.col("clave_persona").cast("string"), F.col("clave_edicion_producto").cast("string")
    t = F.col("fecha_rotulacion_finalizacion")
    return p.select(
        (F.col("clave_detalle_compra") + F.lit(2**53 + 1)).cast("string").alias("clave_detalle_compra"),
        F.when(kind == 0, F.concat(F.lit("00"), person))
        .when(kind == 1, F.concat(person, F.lit(".0")))
        .when(kind == 2, (F.col("clave_persona") + F.lit(2**53 + 1)).cast("string"))
        .when(kind == 3, F.lit(" "))
        .otherwise(F.concat(F.lit(" "), person, F.lit(" ")))
        .alias("clave_persona"),
        F.when(kind == 1, F.concat(edition, F.lit(".0"))).otherwise(edition).alias("clave_edicion_producto"),
        F.when(kind == 4, F.date_format(t, "yyyy-MM-dd")).otherwise(F.date_format(t, "yyyy-MM-dd HH:mm:ss")).alias("fecha_rotulacion_finalizacion"),
        F.concat(F.lit("00"), F.col("numero_boleto").cast("string")).alias("numero_boleto"),
    )


def fixture_editions_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The editions as a text extract: types and numbers as ``"1.0"`` or blank, times as text."""
    e = fixture_editions(spark, sf_dir)
    n = F.col("numero_sorteo")
    time = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("fecha_inicio", "fecha_fin")]
    return e.select(
        F.col("clave_edicion_producto").cast("string").alias("clave_edicion_producto"),
        F.concat(F.col("tipo_producto").cast("string"), F.lit(".0")).alias("tipo_producto"),
        F.when(n % 7 == 0, F.lit("")).otherwise(F.concat(n.cast("string"), F.lit(".0"))).alias("numero_sorteo"),
        "desc_sorteo",
        "desc_corta_sorteo",
        *time,
        F.lit("").alias("fecha_celebracion"),
    )


def fixture_day_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days as text, from ``events.ts``: plain, blank, with letters, with spaces around."""
    ev = _read(spark, sf_dir, "events").select("event_id", "ts")
    day, r = F.date_format("ts", "yyyy-MM-dd"), F.col("event_id") % 4
    text = F.when(r == 0, day).when(r == 1, F.lit("")).when(r == 2, F.concat(F.lit("x"), day)).otherwise(F.concat(F.lit(" "), day, F.lit(" ")))
    return ev.select("event_id", text.alias("t"))


def irregular_editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The editions with repeated keys, missing values, out-of-order ends and one that ended today."""
    e = fixture_editions(spark, sf_dir)
    n, tp, fin = F.col("numero_sorteo"), F.col("tipo_producto"), F.col("fecha_fin")
    today = F.lit("2001-08-02 06:00:00").cast("timestamp_ntz")
    late = fin + F.make_dt_interval(F.lit(150))
    changed = e.select(
        "clave_edicion_producto",
        F.when(n % 11 != 0, tp).alias("tipo_producto"),
        F.when(n % 13 != 0, n - (n % 6 == 5).cast("int")).alias("numero_sorteo"),  # two editions with one number
        "desc_sorteo",
        "desc_corta_sorteo",
        F.when(n % 10 != 0, F.col("fecha_inicio")).alias("fecha_inicio"),
        F.when((tp == 3) & (n == 39), today).when(n % 8 == 3, late).otherwise(fin).alias("fecha_fin"),
        "fecha_celebracion",
    )
    again = changed.where(F.col("clave_edicion_producto") % 9 == 0).withColumn("fecha_fin", F.col("fecha_fin") - F.make_dt_interval(F.lit(3)))
    return changed.unionByName(again)


def irregular_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchases with missing customers and times, and with missing and repeated keys."""
    p, k = fixture_purchases(spark, sf_dir), F.col("clave_detalle_compra")
    return p.withColumns(
        {
            "clave_persona": F.when(k % 17 != 0, F.col("clave_persona")),
            "fecha_rotulacion_finalizacion": F.when(k % 19 != 0, F.col("fecha_rotulacion_finalizacion")),
            "clave_detalle_compra": F.when(k % 23 != 0, k - k % 500),
        }
    )


def fixture_purchases_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchases as a text extract with the words that stand for missing values, and with numbers that are none."""
    p, k = fixture_purchases(spark, sf_dir), F.col("clave_detalle_compra")
    person, ticket = k % 11, k % 7
    columns = (
        k.cast("string").alias("clave_detalle_compra"),
        F.when(person == 0, "NA").when(person == 1, "None").when(person == 2, "nan").when(person == 3, "abc").when(person == 4, "")
        .otherwise(F.col("clave_persona").cast("string")).alias("clave_persona"),
        F.col("clave_edicion_producto").cast("string").alias("clave_edicion_producto"),
        F.date_format("fecha_rotulacion_finalizacion", "yyyy-MM-dd HH:mm:ss").alias("fecha_rotulacion_finalizacion"),
        F.when(ticket == 0, "null").when(ticket == 1, "99999999999999999999").when(ticket == 2, "#N/A")
        .otherwise(F.concat(F.coalesce(F.col("numero_boleto"), F.lit(0)).cast("string"), F.lit(".0"))).alias("numero_boleto"),
    )
    # Made once a row, as a read text is: every rule would repeat a plain expression.
    return p.select(F.explode(F.array(F.struct(*columns))).alias("row")).select("row.*")
