"""Readers and writers: parquet (default), CSV with fixed schemas, and catalog tables.

Readers never infer schemas. Text extracts are read as all-string and cleaned with the
same casts the typed path uses, so both give identical DataFrames.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edflux.functions.casts import lenient_int, lenient_long, token_to_null
from edflux.functions.dates import parse_day
from edflux.operators.prepare import clean_editions, clean_purchases
from edflux.schemas import EDITION_COLUMNS, PURCHASE_COLUMNS, ROLLUP
from edflux.sources.publish import SNAPSHOT_DAY, pick_day, replace_path, replace_table, shuffles_released, snapshot_days

FORMATS = ("parquet", "csv", "table")

# Quotes inside quoted fields are doubled, as spreadsheets and Python's csv module write them.
CSV_QUOTING = {"quote": '"', "escape": '"'}


def _read(spark: SparkSession, location: str, fmt: str, options=None) -> DataFrame:
    """The columns as stored; those of a CSV are all text, named by its header."""
    if fmt == "parquet":
        return spark.read.parquet(location)
    if fmt == "csv":
        # multiLine: a quoted field may hold line feeds; options={"multiLine": False} lets
        # Spark split large files that have none.
        own = {"header": True, "mode": "FAILFAST", "multiLine": True, **CSV_QUOTING, **(options or {})}
        raw = spark.read.options(**own).csv(location)
        text = {f.name for f in raw.schema if isinstance(f.dataType, T.StringType)}  # a partition's column is typed
        return raw.select(*(token_to_null(F.col(f"`{c}`")).alias(c) if c in text else F.col(f"`{c}`") for c in raw.columns))
    if fmt == "table":
        return spark.table(location)
    raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")


def read_purchases(
    spark: SparkSession, location: str, fmt: str = "parquet", options: dict | None = None
) -> DataFrame:
    """The purchase fact: its nine columns by name, typed (text is parsed, see ``clean_purchases``)."""
    raw = _read(spark, location, fmt, {"multiLine": False, **(options or {})})  # no free text: stays splittable
    present = [c for c in PURCHASE_COLUMNS if c in raw.columns]
    return clean_purchases(raw.select(*present))


def read_editions(
    spark: SparkSession, location: str, fmt: str = "parquet", options: dict | None = None, strict: bool = False
) -> DataFrame:
    """The edition dimension, typed (unknown extra columns are ignored; ``strict``: no null keys)."""
    raw = _read(spark, location, fmt, options)
    present = [c for c in EDITION_COLUMNS if c in raw.columns]
    return clean_editions(raw.select(*present), strict)


def read_rollup(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    options: dict | None = None,
    lenient_dates: bool = False,
) -> DataFrame:
    """A stored rollup (e.g. a dated snapshot) with the 21 typed columns.

    CSV dates are ``yyyy-MM-dd`` text: a malformed one fails the read, or becomes null
    with ``lenient_dates=True``. ``options={"multiLine": False}`` splits large CSV files, if no
    column holds a line feed (ours hold none).
    """
    return typed_rollup(_read(spark, location, fmt, options), lenient_dates)


def typed_rollup(raw: DataFrame, lenient_dates: bool = False) -> DataFrame:
    """The 21 columns of ``schemas.ROLLUP`` with its types, whatever the store kept them as.

    Text is parsed (dates as ``yyyy-MM-dd``); timestamps become their day, other numbers are
    cast. Nested detail lists become JSON text.
    """

    def column(f: T.StructField) -> Column:
        c, held = F.col(f.name), raw.schema[f.name].dataType
        if isinstance(held, T.StringType):
            rule = {T.DateType: lambda x: parse_day(x, lenient_dates), T.IntegerType: lenient_int, T.LongType: lenient_long}.get(type(f.dataType))
            c = rule(c) if rule else c
        elif isinstance(held, T.ArrayType):
            c = F.to_json(c, {"ignoreNullFields": "false"})
        return c.cast(f.dataType).alias(f.name)

    return raw.select(*(column(f) for f in ROLLUP.fields))


def read_snapshot(
    spark: SparkSession,
    location: str,
    as_of: date | str | None = None,
    fmt: str = "parquet",
    lenient_dates: bool = False,
) -> DataFrame:
    """The rollup snapshot of the last stored day (not after ``as_of``), with the 21 typed columns.

    Only that day's partition is read. Snapshots are written by
    :func:`edflux.sources.publish.write_snapshot`.
    """
    day = pick_day(snapshot_days(spark, location, fmt), as_of, location)
    raw = _read(spark, location, fmt, {"multiLine": False}).where(F.col(SNAPSHOT_DAY).cast("date") == F.lit(day))
    return typed_rollup(raw, lenient_dates)


def write(df: DataFrame, location: str, fmt: str = "parquet", mode: str = "overwrite", **options) -> None:
    """Write ``df`` replacing what is there (``mode='overwrite'``), or in another Spark mode.

    A replacement is staged and swapped in (see :mod:`edflux.sources.publish`): a job that fails
    leaves the old result, and ``df`` may read what it replaces. ``fmt='csv'`` writes a
    header, ``yyyy-MM-dd`` dates and ``yyyy-MM-dd HH:mm:ss.ffffff`` timestamps; ``fmt='table'``
    writes a catalog table (``saveAsTable``). Partitioning columns can be passed as
    ``partitionBy=[...]``.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
    partition_by = options.pop("partitionBy", None)

    def save(place: str) -> None:
        writer = df.write.mode(mode).options(**options)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if fmt == "table":
            writer.saveAsTable(place)
        elif fmt == "csv":
            # Timestamps in the extract's text form, which the purchase-time parser accepts.
            (
                writer.options(header=True, **CSV_QUOTING)
                .option("dateFormat", "yyyy-MM-dd")
                .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
                .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
                .csv(place)
            )
        else:
            writer.parquet(place)

    with shuffles_released(df.sparkSession):
        if mode != "overwrite":
            save(location)
        elif fmt == "table":
            replace_table(df.sparkSession, location, save)
        else:
            replace_path(df.sparkSession, location, save)
