"""Vectorized hashing over the bytes of many texts at once.

A text's prefix sums of table[byte] * base**position (mod 2**64) give the hash of any substring as a difference
times a power of the inverse base; a final mix spreads it over all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes worked on at once; a longer text is a block of its own.
BLOCK = 1 << 21
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
U = np.uint64


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for x in (BASE, INVERSE):
        p = np.full(n + 1, U(x), np.uint64)
        p[0] = 1
        np.cumprod(p, out=p)
        out.append(p)
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, at least."""
    return _powers(BLOCK if n <= BLOCK else 1 << int(n).bit_length())


@lru_cache
def table() -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)


def mix(h: np.ndarray) -> np.ndarray:
    """In place: every bit of the result depends on every bit of h."""
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(29)
    h *= U(0xA0761D6478BD642F)
    h ^= h >> U(32)
    return h


def prefix(data: np.ndarray) -> np.ndarray:
    """len(data) + 1 prefix sums for substring()."""
    up, _ = powers(len(data))
    p = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table()[data] * up[: len(data)], out=p[1:])
    return p


def substrings(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of [start, end)."""
    _, down = powers(len(p))
    return mix((p[end] - p[start]) * down[start] + (end - start).astype(np.uint64) * U(0x2545F4914F6CDD1D))


def blocks(column: pa.Array, most: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows of a string or binary column, of about `most` bytes each. A null is empty."""
    column = column.cast(pa.large_binary()) if column.type not in (pa.large_binary(), pa.binary()) else column
    if column.null_count:
        column = column.fill_null(b"")
    width = np.int64 if column.type == pa.large_binary() else np.int32
    _, offs, buf = column.buffers()
    ends = np.frombuffer(offs, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + most, side="right")) - 1)
        yield a, data[ends[a] : ends[b]], ends[a : b + 1] - ends[a]
        a = b


@lru_cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    blank = np.zeros(256, bool)
    blank[[0x20, *range(9, 14)]] = True
    return low, blank


def words_at(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words (runs of other bytes than ASCII blanks, A-Z lower-cased), the row and the end of each."""
    low, blank = _classes()
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ink = np.zeros(len(data) + 2, bool)
    ink[1:-1] = ~blank[data]
    first = np.zeros(len(data) + 1, bool)  # rows begin here
    first[offsets[:-1]] = True
    begin = np.flatnonzero(ink[1:-1] & (~ink[:-2] | first[:-1]))
    end = np.flatnonzero(ink[1:-1] & (~ink[2:] | np.append(first[1:-1], True))) + 1
    rows = np.searchsorted(offsets, begin, side="right") - 1
    return substrings(prefix(low[data]), begin, end), rows, end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return words_at(data, offsets)[:2]


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingles of each row; fewer words than k are one shingle, no words none."""
    w, rows = words(data, offsets)
    n = np.bincount(rows, minlength=len(offsets) - 1)
    first = np.cumsum(n) - n
    h = np.zeros(max(0, len(w) - k + 1), np.uint64)
    for j in range(k):
        h += w[j : j + len(h)] * U(pow(0xD1342543DE82EF95, j + 1, 1 << 64))
    mix(h)
    out = []
    for a, m in zip(first.tolist(), n.tolist(), strict=True):
        if m >= k:
            out.append(np.unique(h[a : a + m - k + 1]))
        elif m:
            short = (w[a : a + m] * np.array([pow(0xF1357AEA2E62A9C5, j + 1, 1 << 64) for j in range(m)], np.uint64)).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(short + U(m)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
