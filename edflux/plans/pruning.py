"""Run-time pruning of a fact scan by the keys of a small table.

A join with a small table tells Spark which fact rows to keep, but only after they have been
read, unless the facts are partitioned by the key. Here the small table's keys are read first:

- :func:`key_ranges` turns at most ``max_keys`` of them into a few disjoint ranges. As literals
  in a filter they reach the parquet scan (``PushedFilters``) and drop row groups by their
  minimum and maximum, which helps a table sorted or loosely clustered by the key.
- More keys than that give one range from two aggregates, and :func:`in_bitmap` drops the rest
  of the unwanted rows in front of a shuffle join: a bitmap of hashed keys (a Bloom filter with one hash),
  broadcast at a size that depends on ``bits`` alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_KEYS = 100_000  # integers collected on the driver at most
MAX_RANGES = 16
BITMAP_BITS = 1 << 26  # 8 MB
_BUCKET_BITS = 1 << 15  # of bitmap_construct_agg


@dataclass(frozen=True)
class KeyRanges:
    """Disjoint inclusive ranges that hold all keys, and whether all keys were read for them."""

    ranges: tuple[tuple[int, int], ...]
    exact: bool

    def test(self, column: Column) -> Column:
        """Whether a key may be among them (false for null)."""
        if not self.ranges:
            return F.lit(False)
        tests = [(column == a) if a == b else ((column >= a) & (column <= b)) for a, b in self.ranges]
        return reduce(or_, tests)


def widest_gaps(keys: list[int], max_ranges: int = MAX_RANGES) -> tuple[tuple[int, int], ...]:
    """Ranges that hold all of the sorted distinct ``keys``, split at the widest gaps between them."""
    if not keys:
        return ()
    gaps = sorted(range(1, len(keys)), key=lambda i: (keys[i - 1] - keys[i], i))
    cuts = sorted(i for i in gaps[: max_ranges - 1] if keys[i] - keys[i - 1] > 1)
    return tuple((keys[a], keys[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True))


def key_ranges(small: DataFrame, key: str, max_keys: int = MAX_KEYS, max_ranges: int = MAX_RANGES) -> KeyRanges:
    """The ranges of the keys in ``small`` (nulls left out); one small job, two beyond ``max_keys``."""
    keys = small.select(key).where(F.col(key).isNotNull())
    held = [r[0] for r in keys.limit(max_keys + 1).collect()]
    if len(held) <= max_keys:
        return KeyRanges(widest_gaps(sorted(set(held)), max_ranges), True)
    low, high = keys.agg(F.min(key), F.max(key)).first()
    return KeyRanges(((low, high),), False)


def _slot(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_bitmap(small: DataFrame, key: str, bits: int = BITMAP_BITS) -> DataFrame:
    """The bitmap of the hashed keys: a row for each of ``bits`` / 32,768 runs that has any."""
    slot = _slot(key, bits)
    run = F.floor(slot / _BUCKET_BITS).cast("long")
    return small.where(F.col(key).isNotNull()).groupBy(run.alias("__run")).agg(F.bitmap_construct_agg(slot % _BUCKET_BITS).alias("__bits"))


def in_bitmap(big: DataFrame, bitmap: DataFrame, key: str, bits: int = BITMAP_BITS) -> DataFrame:
    """The rows of ``big`` whose key may be in the bitmap: all that are, and few others."""
    slot = _slot(key, bits)
    tested = big.withColumn("__slot", slot % _BUCKET_BITS).withColumn("__run", F.floor(slot / _BUCKET_BITS).cast("long"))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(F.col("__slot") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (F.col("__slot") % 8).cast("int")) == 1
    return tested.join(F.broadcast(bitmap), "__run").where(hit).drop("__run", "__bits", "__slot").select(*big.columns)


def near_keys(facts: DataFrame, small: DataFrame, key: str, max_keys: int = MAX_KEYS, bits: int = BITMAP_BITS) -> DataFrame:
    """``facts`` without most rows whose ``key`` isn't in ``small``; no row with such a key is lost."""
    found = key_ranges(small, key, max_keys)
    kept = facts.where(found.test(F.col(key)))
    return kept if found.exact else in_bitmap(kept, key_bitmap(small, key, bits), key, bits)
