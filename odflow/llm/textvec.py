"""Words of whole Arrow text columns as 64-bit hashes, with numpy.

A column's UTF-8 bytes are handled together, in stretches of whole texts of
about STRETCH bytes (a longer text is a stretch by itself), so memory follows
the largest of STRETCH and the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STRETCH = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def stretches(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], width, column.offset + n + 1)[column.offset:].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + STRETCH, "right")) - 1
        end = min(n, max(row + 1, end))
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


class WordHasher:
    """Hashes of the words (runs of anything but ASCII white space) of texts,
    A to Z counting as a to z."""

    def __init__(self, seed: int = 1) -> None:
        table = np.random.default_rng(seed).integers(1, 2**63, 256).astype(np.uint64)
        table[65:91] = table[97:123]
        self.table = table
        self.space = np.zeros(256, bool)
        self.space[[32, 9, 10, 11, 12, 13]] = True
        self.base = 0x9E3779B97F4A7C15
        self.inverse = pow(self.base, -1, 2**64)
        self._grow(STRETCH + 1)

    def _grow(self, size: int) -> None:
        def powers(x):
            out = np.full(size, x, np.uint64)
            out[0] = 1
            return np.cumprod(out, dtype=np.uint64)
        self.power, self.unpower = powers(self.base), powers(self.inverse)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, first word of each text and the end, start bytes, end bytes)."""
        size = len(data)
        if size >= len(self.power):
            self._grow(size + 1)
        word = ~self.space[data]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        starts = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[starts] = word[starts]
        ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        last[ends] = word[ends]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.empty(size + 1, np.uint64)
        total[0] = 0
        np.cumsum(self.table[data] * self.power[:size], dtype=np.uint64, out=total[1:])
        h = (total[e] - total[s]) * self.unpower[s]
        return mix(h + (e - s).astype(np.uint64)), np.searchsorted(s, offsets), s, e


def shingles(h: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words of each text, and where each text's
    begin; a text of fewer words has its whole sequence as one."""
    n = np.diff(bounds)
    factors = mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    g = np.zeros(len(h), np.uint64)
    for j in range(k):
        g[: len(h) - j] += h[j:] * factors[j]
    end = np.repeat(bounds[1:], n)
    at = np.arange(len(h))
    keep = at + k <= end
    for d in np.flatnonzero((n > 0) & (n < k)):
        a = bounds[d]
        g[a] = np.uint64(n[d]) + np.sum(h[a:bounds[d + 1]] * factors[: n[d]], dtype=np.uint64)
        keep[a] = True
    return mix(g[keep]), np.concatenate([[0], np.cumsum(np.where(n >= k, n - k + 1, n > 0))])
