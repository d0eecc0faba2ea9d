"""Shared folder tables, Arrow batch slicing and small column helpers."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edflux.session import ensure_checkpoint_dir

#: Word separators of the whitespace word rule: space and the control characters 9 to 13.
SPACE = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor loses no rows of it, and what was drawn once (row
    numbers, chunk numbers) stays as written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    return (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")


def total(df: DataFrame, column) -> int:
    """One number over all rows (0 for an empty table)."""
    return df.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0]


def parts(spark: SparkSession, amount: float, each: float) -> int:
    """How many groups of ``each`` hold ``amount``, no fewer than the shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(amount / each))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with at most ``limit`` bytes in ``column`` (or a single row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        at, size = 0, 0
        for i, n in enumerate(sizes):
            if size + n > limit and i > at:
                yield batch.slice(at, i - at)
                at, size = i, 0
            size += int(n)
        yield batch.slice(at)


def mask(text: Column, spans: Column, tag) -> Column:
    """``text`` with every span of ``spans`` (sorted structs with start and end in code points) replaced.

    ``tag`` makes the replacement from a span; what overlaps the span before it goes without one.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, s):
        hole = F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), tag(s))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] < a["at"], a["out"]).otherwise(hole).alias("out"))

    whole = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def set_apart(df: DataFrame, names: str) -> DataFrame:
    """``df`` with those of its columns renamed that clash with ``names``; :func:`put_back` undoes it."""
    clash = set(names.split())
    return df.select(*(F.col(f"`{c}`").alias(f"__own_{c}" if c.lower() in clash else c) for c in df.columns))


def put_back(df: DataFrame, columns: list[str], names: str) -> DataFrame:
    clash = set(names.split())
    return df.select(*(F.col(f"`__own_{c}`" if c.lower() in clash else f"`{c}`").alias(c) for c in columns))
