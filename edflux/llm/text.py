"""Words of UTF-8 text as arrays: positions, 64-bit hashes and window hashes without Python loops.

A batch of texts is one byte buffer with offsets. All separators used here are ASCII bytes,
so bytes can stand for characters. Hashes are polynomials modulo 2**64 over random byte
values, finished with a bit mixer; every worker draws the same tables from a fixed seed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_LONG = 64  # words over this many bytes are hashed one by one
_BLOCK = 1 << 16
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 flags, true within the inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: The separators of ``[^\x20\x09-\x0D]+`` and of words made of digits, letters and non-ASCII.
BLANKS = byte_class((0x20, 0x20), (0x09, 0x0D))
NOT_WORD = byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    kind = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    _, at, data = column.buffers()
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(at, kind, n + 1 + column.offset)[column.offset :].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def word_spans(buf: np.ndarray, off: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of bytes that ``gap`` doesn't flag."""
    n = len(buf)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none
    word = ~gap[buf]
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    before[off[:-1][off[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse, at least ``n`` of each."""
    got = _powers.get(base)
    if got is None or len(got[0]) < n:
        size = max(n, _BLOCK + _LONG, 2 * (len(got[0]) if got else 0))
        up = np.full(size, base, U)
        down = np.full(size, pow(base, -1, 2**64), U)
        up[0] = down[0] = 1
        got = _powers[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return got


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = h ^ U(salt)
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, computed in blocks of bytes."""
    out = np.empty(len(starts), U)
    size = ends - starts
    long = np.flatnonzero(size > _LONG)
    up, down = _power(_BASE, _BLOCK + _LONG)
    at = 0
    while at < len(starts):
        first = starts[at]
        to = max(at + 1, int(np.searchsorted(starts, first + _BLOCK, side="left")))
        seg = buf[first : min(ends[to - 1], first + _BLOCK + _LONG)]
        total = np.empty(len(seg) + 1, U)
        total[0] = 0
        np.cumsum(_BYTE[seg] * up[: len(seg)], out=total[1:])
        s = starts[at:to] - first
        e = np.minimum(ends[at:to] - first, len(seg))
        out[at:to] = (total[e] - total[s]) * down[s]
        at = to
    out ^= size.astype(U) << U(56)
    for i in long:
        out[i] = xxhash.xxh3_64_intdigest(buf[starts[i] : ends[i]].tobytes())
    return mix(out)


def window_hashes(words: np.ndarray, k: int, salt: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words; ``salt`` gives independent hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, U)
    base = (_BASE ^ (2 * salt)) | 1
    up, down = _power(base, len(words) + 1)
    total = np.empty(len(words) + 1, U)
    total[0] = 0
    np.cumsum(mix(words, salt) * up[: len(words)], out=total[1:])
    return mix((total[k:] - total[:n]) * down[:n], salt + 1)


def runs_within(row: np.ndarray, k: int) -> np.ndarray:
    """Indices of words that start ``k`` consecutive words of one row."""
    n = len(row) - k + 1
    return np.flatnonzero(row[:n] == row[k - 1 :]) if n > 0 else np.empty(0, np.int64)
