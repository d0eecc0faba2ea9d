"""Broadcast only behind checked bounds of rows and bytes, with a shuffle join beyond it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# Edition-sized tables: a few thousand rows in practice. Beyond either bound the
# planner's sort-merge join takes over instead of a broadcast.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20


def bounded_broadcast(
    df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
) -> DataFrame:
    """Hint ``df`` for broadcast if it is within both bounds, else leave it to the planner (see :func:`is_bounded`)."""
    return F.broadcast(df) if is_bounded(df, max_rows, max_bytes) else df


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: those of its texts, and eight for every column."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema if isinstance(f.dataType, (StringType, BinaryType))]
    return reduce(lambda a, b: a + b, texts, F.lit(8 * len(df.columns))).cast("bigint")


def is_bounded(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` (flat columns) has at most ``max_rows`` rows of ``max_bytes`` in all.

    Rows are measured where they stand, and only their sizes, of ``max_rows + 1`` rows a partition
    at most, are brought together: a wide text never passes through one task to be measured.
    """
    sizes = df.select(row_bytes(df).alias("size")).limit(max_rows + 1)
    found = sizes.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    return found["n"] <= max_rows and found["size"] <= max_bytes


def salted_join(big: DataFrame, small: DataFrame, key: str, spread_col: str, fanout: int = 64) -> DataFrame:
    """Equi join on a low-cardinality ``key`` without broadcasting ``small`` and without hot tasks.

    The fallback for a "small" side that failed its size check: ``small`` is replicated
    ``fanout`` times with a salt, ``big`` takes the salt from a hash of ``spread_col``, and
    the shuffle join on (key, salt) spreads each key value over ``fanout`` tasks.
    """
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(fanout - 1))))
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(F.col(spread_col)), F.lit(fanout)).cast("int"))
    return salted_big.join(salted_small, [key, "_salt"], "inner").drop("_salt")
