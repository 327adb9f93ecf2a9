"""Vectorised word kernels over Arrow string columns, shared by the operators.

A *word* is a run of bytes that are not ASCII white space (``\\x20`` and
``\\x09``-``\\x0D``); as every byte of a multi-byte UTF-8 character is above 0x7F,
words of bytes are words of characters. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: texts are taken in slices of about this size, which bounds what the arrays below hold
SLICE_BYTES = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_GRAM_BASES = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_M = (1 << 64) - 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i in 0..n."""
    if base not in _powers or len(_powers[base][0]) <= n:
        size = 1 << max(12, int(n).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            step = np.full(size, b, np.uint64)
            step[0] = 1
            both.append(np.multiply.accumulate(step))
        _powers[base] = (both[0], both[1])
    return _powers[base]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ranges_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[s:e] for each pair, by differences of a wrapped prefix sum."""
    up, down = powers(base, len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def pieces(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes; one row is never split."""
    offsets = text_offsets(column)[0]
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def text_offsets(column: pa.Array) -> tuple[np.ndarray, pa.Buffer | None]:
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    bufs = column.buffers()
    if bufs[1] is None or len(column) == 0:
        return np.zeros(len(column) + 1, np.int64), None
    off = np.frombuffer(bufs[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return off, bufs[2]


class Words:
    """Words of some texts: byte ranges, and the row that each belongs to."""

    def __init__(self, column: pa.Array, lower: bool = False):
        off, data = text_offsets(column)
        raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
        off = off - off[0]
        if lower:
            raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
        solid = ~_SPACE[raw]
        n = len(raw)
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        start = solid.copy()
        end = solid.copy()
        if n:
            start[1:] &= ~solid[:-1] | edge[1:n]
            end[:-1] &= ~solid[1:] | edge[1:n]
        self.raw, self.offsets = raw, off
        self.starts = np.flatnonzero(start)
        self.ends = np.flatnonzero(end) + 1
        #: words[first[i]:first[i + 1]] are those of row i
        self.first = np.searchsorted(self.starts, off)
        self.rows = np.repeat(np.arange(len(off) - 1), np.diff(self.first))
        self._h: dict[int, np.ndarray] = {}

    def hashes(self, which: int = 0) -> np.ndarray:
        if which not in self._h:
            self._h[which] = ranges_hash(self.raw.astype(np.uint64) + np.uint64(1), self.starts, self.ends, _BASES[which])
        return self._h[which]

    def grams(self, k: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the words at which k words of one row start, and the hashes of those."""
        n = len(self.starts)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.rows[: n - k + 1] == self.rows[k - 1 :])
        return at, ranges_hash(self.hashes(which), at, at + k, _GRAM_BASES[which])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
