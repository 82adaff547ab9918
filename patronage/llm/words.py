"""Words, word hashes and word windows of whole Arrow batches, in numpy.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D.  Every function works
on the joined bytes of many documents at once; `slices` cuts a batch so that the
working arrays stay bounded by SLICE_BYTES (or by one document, if that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_GRAM = _U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


class _Powers:
    """Powers of a base modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self._base, self._table = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self._table) < n:
            step = _U(pow(self._base, len(self._table), 2**64))
            self._table = np.concatenate([self._table, self._table * step])
        return self._table[:n]


_POWERS, _INVERSES = _Powers(_BASE), _Powers(_BASE_INVERSE)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The joined bytes of a string or binary column and each value's start; nulls are empty."""
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = column.cast(pa.large_binary() if binary else pa.large_string()).fill_null(b"" if binary else "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, starts) of consecutive rows of at most `limit` bytes."""
    data, starts = text_bytes(column)
    row, n = 0, len(starts) - 1
    while row < n:
        to = int(np.searchsorted(starts, starts[row] + limit, side="right")) - 1
        to = min(max(to, row + 1), n)
        yield row, to, data[starts[row] : starts[to]], starts[row : to + 1] - starts[row]
        row = to


@dataclass
class Words:
    """Words of several texts; `first[i]` is the index of text i's first word, `first[-1]` their number."""

    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text each word lies in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def range_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges; equal bytes hash alike wherever they lie."""
    n = len(data)
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * _POWERS.upto(n), out=summed[1:])
    return mix((summed[end] - summed[begin]) * _INVERSES.upto(n + 1)[begin])


def words_of(data: np.ndarray, starts: np.ndarray) -> Words:
    """Positions and 64-bit hashes of the words of several joined texts."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(starts), np.int64), np.zeros(0, np.uint64))
    inside = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    after_gap = np.empty(n, bool)
    after_gap[0] = True
    np.logical_not(inside[:-1], out=after_gap[1:])
    begin = np.flatnonzero(inside & (after_gap | edge[:n]))
    before_gap = np.empty(n, bool)
    before_gap[-1] = True
    np.logical_not(inside[1:], out=before_gap[:-1])
    end = np.flatnonzero(inside & (before_gap | edge[1:])) + 1
    return Words(begin, end, np.searchsorted(begin, starts), range_hashes(data, begin, end))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; the last k - 1 positions are left out."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= _GRAM
        out += hashes[j : j + n]
    return mix(out)


def starts_inside(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the first n word positions begin k words of one text."""
    ok = np.zeros(n + 1, np.int32)
    counts = np.diff(first)
    full = counts >= k
    np.add.at(ok, np.minimum(first[:-1][full], n), 1)
    np.add.at(ok, np.minimum(first[1:][full] - k + 1, n), -1)
    return np.cumsum(ok[:n]) > 0


def least_of_windows(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least value among `width` neighbours from each position on, and its leftmost position."""
    best, at = values, np.arange(len(values))
    have = 1
    while have < width:
        step = min(have, width - have)
        if len(best) <= step:
            return best[:0], at[:0]
        left, right = best[:-step], best[step:]
        take = right < left
        best = np.where(take, right, left)
        at = np.where(take, at[step:], at[:-step])
        have += step
    return best, at


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return np.ascontiguousarray(x).view(np.int64)
