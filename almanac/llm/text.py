"""Vectorised helpers over Arrow text columns, shared by the operators that run in Python.

An Arrow string column is one byte buffer plus offsets, so words, their hashes and
n-gram hashes of a whole batch come from a few numpy passes without a Python object
per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Separators of the whitespace-delimited words: space and \x09-\x0D.
WS = np.zeros(256, bool)
WS[[0x20, 9, 10, 11, 12, 13]] = True
#: Separators of the alphanumeric words: all ASCII but 0-9 and a-z (after lower-casing); bytes over 0x7F belong to words.
PUNCT = np.zeros(256, bool)
PUNCT[0x00:0x30] = PUNCT[0x3A:0x61] = PUNCT[0x7B:0x80] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def trim() -> None:
    """Give memory that a finished piece of work has freed back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _find_trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return None


_TRIM = _find_trim()


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A random value for each byte.
BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_WORD_BASE = 0x2545F4914F6CDD1D


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([1], np.full(max(n - 1, 0), base))).astype(U64))[:n]


_POW = _powers(_BASE, 4096)


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One contiguous string array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins (one more entry than texts)."""
    column = plain(column)
    _, off, data = column.buffers()
    at = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def pieces(column: pa.Array, most: int, rows: int = 1 << 16) -> Iterator[tuple[int, int]]:
    """Ranges of at most so many rows and about ``most`` bytes each (a longer text stands alone), for bounded temporaries."""
    n = len(column)
    if not n:
        return
    _, at = raw(column)
    i = 0
    while i < n:
        j = max(i + 1, min(i + rows, int(np.searchsorted(at, at[i] + most, "right")) - 1))
        yield i, j
        i = j


def words(data: np.ndarray, at: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and the index of each text's first word (one more entry than texts)."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(at), np.int64)
    inside = ~sep[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:-1]
    end = inside
    end = end.copy()
    end[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE, at_once: int = 1 << 19) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over random values of its bytes, mixed with its length.

    Words are taken in slices of about ``at_once`` bytes, so the temporaries stay small and in cache.
    """
    global _POW
    n = len(starts)
    out = np.empty(n, U64)
    if not n:
        return out
    length = ends - starts
    if (longest := int(length.max())) > len(_POW):
        _POW = _powers(_BASE, longest)
    stop = np.cumsum(length)
    i = 0
    while i < n:
        base = int(stop[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(stop, base + at_once, "right")))
        size = length[i:j]
        first = stop[i:j] - size - base
        rel = np.arange(int(stop[j - 1]) - base)
        byte = data[rel + np.repeat(starts[i:j] - first, size)]
        rel -= np.repeat(first, size)
        out[i:j] = np.add.reduceat(values[byte] * _POW[rel], first)
        i = j
    return mix(out + length.astype(U64) * U64(0x9E3779B97F4A7C15))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive entries; entry i covers i .. i+n-1, the last n-1 are absent."""
    if len(h) < n:
        return np.zeros(0, U64)
    have: dict[int, np.ndarray] = {1: h}

    def of(k: int) -> np.ndarray:
        if k not in have:
            a = k // 2
            left, right = of(k - a), of(a)
            m = len(h) - k + 1
            have[k] = left[:m] * U64(pow(_WORD_BASE, a, 1 << 64)) + right[k - a : k - a + m]
        return have[k]

    return mix(of(n))


def docs_of(first: np.ndarray) -> np.ndarray:
    """For each word the index of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true values."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def xxh64_longs(x: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of 64-bit integers as Spark's xxhash64 gives it for a long column."""
    p1, p2, p3, p4, p5 = (U64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def rotl(v: np.ndarray, r: int) -> np.ndarray:
        return v << U64(r) | v >> U64(64 - r)

    h = (p5 + U64(seed + 8)) ^ rotl(x.astype(np.int64).view(U64) * p2, 31) * p1
    h = rotl(h, 27) * p1 + p4
    h = (h ^ h >> U64(33)) * p2
    h = (h ^ h >> U64(29)) * p3
    return (h ^ h >> U64(32)).view(np.int64)


def slices(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column of the bytes of data[bounds[k] : bounds[k + 1]] for each k, without a copy of each."""
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * data.dtype.itemsize).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def joined(column: pa.Array | pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    """All bytes of a binary column as one array."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, kind)
