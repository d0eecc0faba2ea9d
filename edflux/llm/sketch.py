"""A count-min sketch of 64-bit hashes, built per partition, merged by slices on the executors.

Counts saturate at two, which is all a "seen more than once?" question needs: a cell of a
partial sketch is absent, once or more. The merged sketch is one bit per cell ("two or
more"), so its size is the parameter ``cells``, whatever the input. Counts are never too
low; with more hashes than cells more of them are reported as repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from edflux.llm.text import U, mix

DEPTH = 2
_SLICE = 21  # log2 of the cells of a slice
_FLUSH = 1 << 22
_PARTIAL = "depth int, slice int, seen binary, more binary"
_SCHEMA = pa.schema([("depth", pa.int32()), ("slice", pa.int32()), ("seen", pa.binary()), ("more", pa.binary())])


def log2_cells(amount: int, most: int = 27) -> int:
    """log2 of a power of two of about ``amount`` cells, 2**``most`` at most."""
    return min(most, max(16, int(amount).bit_length()))


def cell(hashes: np.ndarray, depth: int, bits: int) -> np.ndarray:
    return (mix(hashes, 0x51 + depth) >> U(64 - bits)).astype(np.int64)


def _pack(cells: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.diff(cells, prepend=0).astype(np.uint32).tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    return np.cumsum(np.frombuffer(raw, np.uint32).astype(np.int64))


def _partial(hashes: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    joined = np.concatenate(hashes) if hashes else np.empty(0, U)
    if not len(joined):
        return
    for depth in range(DEPTH):
        cells, n = np.unique(cell(joined, depth, bits), return_counts=True)
        which, at = np.unique(cells >> _SLICE, return_index=True)
        for s, lo, hi in zip(which, at, [*at[1:], len(cells)], strict=True):
            own, twice = cells[lo:hi] - (s << _SLICE), n[lo:hi] > 1
            row = ([depth], [int(s)], [_pack(own)], [_pack(own[twice])])
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(row, _SCHEMA, strict=True)], schema=_SCHEMA)


def merged(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> list[np.ndarray]:
    """Bits (little-endian) of the cells counted twice or more, an array for each depth."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for got in hashes(batch):
                held.append(got)
                size += len(got)
                if size >= _FLUSH:
                    yield from _partial(held, bits)
                    held, size = [], 0
        yield from _partial(held, bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                c = counts.setdefault((row["depth"], row["slice"]), np.zeros(1 << min(bits, _SLICE), np.uint8))
                own = _unpack(row["seen"])
                c[own] = np.minimum(c[own] + 1, 2)
                c[_unpack(row["more"])] = 2
        for (depth, s), c in counts.items():
            blob = np.packbits(c > 1, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([depth], pa.int32()), pa.array([s], pa.int32()), pa.array([blob], pa.binary())], ["depth", "slice", "bits"]
            )

    rows = (
        df.mapInArrow(partial, _PARTIAL).repartition("depth", "slice").mapInArrow(merge, "depth int, slice int, bits binary")
    )
    out = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(DEPTH)]
    size = (1 << min(bits, _SLICE)) // 8
    for row in rows.toLocalIterator():  # 2**bits / 8 bytes for each depth, a parameter
        out[row.depth][row.slice * size : (row.slice + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return out


def repeated(sketch: list[np.ndarray], hashes: np.ndarray, bits: int) -> np.ndarray:
    """Flags of the hashes whose estimated count is two or more."""
    out = np.ones(len(hashes), bool)
    for depth, table in enumerate(sketch):
        c = cell(hashes, depth, bits)
        out &= ((table[c >> 3] >> (c & 7).astype(np.uint8)) & 1).astype(bool)
    return out
