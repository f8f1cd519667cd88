"""Array helpers for the Arrow stages: text columns as flat bytes, words and
their hashes, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes that one slice holds (a longer text is a slice of its own).
SLICE_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
#: A random value per byte, and an odd multiplier with its inverse mod 2**64.
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
MULT = int(_rng.integers(1, 1 << 62, dtype=np.uint64)) * 2 + 1
INV = pow(MULT, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words are runs of bytes other than space and TAB to CR.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MULT**i and MULT**-i for i < n (kept between calls)."""
    global _powers, _inverse
    if len(_powers) < n:
        n = max(n, SLICE_BYTES)
        _powers, _inverse = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)])) for x in (MULT, INV))
    return _powers, _inverse


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), off


def slices(off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        j = min(j, n)
        yield i, j
        i = j


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * MULT**i mod 2**64."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(len(values))[0][:len(values)], out=out[1:])
    return out


def spans_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of every span from prefix(): equal spans have equal hashes."""
    return mixed((sums[end] - sums[start]) * powers(len(sums))[1][start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, off: np.ndarray, is_gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each row) for rows off[i]:off[i+1] of data;
    words end at gaps and row ends."""
    lo, hi = int(off[0]), int(off[-1])
    inside = ~is_gap[data[lo:hi]]
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[off - lo] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start + lo, end + lo, np.searchsorted(start, off - lo)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; other bytes as they are."""
    return LOWER[data]


def grams(h: np.ndarray, row_first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words inside a row, and each one's row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    g = h[:n].copy()
    for j in range(1, k):
        g = mixed(g * np.uint64(0x9E3779B97F4A7C15) + h[j:n + j])
    row = np.repeat(np.arange(len(row_first) - 1), np.diff(row_first))
    same = row[:n] == row[k - 1:k - 1 + n]
    return g[same], row[:n][same]
