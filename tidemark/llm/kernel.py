"""Vectorised byte kernels shared by the text operators.

Text reaches Python as Arrow string columns; the UTF-8 buffer is used in place as
one ``uint8`` array per block of documents, and every word, line, shingle or
window is a slice of it.  Slices are fingerprinted in O(1) from prefix sums of two
polynomial hashes modulo the prime 2**31 - 1 with bases and byte values of their own
(62 bits; two slices of n bytes agree by chance with a probability of about 2**-62,
and of (n / 2**31)**2 at most, whatever they hold).  Nothing here loops over
characters or words in Python.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; one longer document forms a block of its own.
BLOCK_BYTES = 1 << 20

_P, _P_BITS = np.uint64((1 << 31) - 1), np.uint64(31)
_rng = np.random.default_rng(20240501)
#: Two bases, and for each a value for every byte.
_BASES = [int(x) for x in _rng.integers(1 << 29, (1 << 31) - 1, 2)]
_VALUES = _rng.integers(1, (1 << 31) - 1, (2, 256)).astype(np.uint64)
_powers: list[list[np.ndarray]] = []
_STRIDE = 1 << 15
#: For short strings of one length, a polynomial modulo 2**64 (not sound for long ones, whatever its base).
SHORT = 64
_BASE64 = 0x9E3779B97F4A7C15 | 1
_BYTE64 = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: ASCII white space: space and tab to carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser; spreads the polynomial hash over all bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _fold(x: np.ndarray) -> np.ndarray:
    """The same value modulo 2**31 - 1; below 2**32 where x is below 2**62."""
    return (x & _P) + (x >> _P_BITS)


def _power_tables(n: int) -> list[list[np.ndarray]]:
    """For each base its powers and those of its inverse, at least n of each."""
    if not _powers or len(_powers[0][0]) < n:
        size, p = max(n, 2 * BLOCK_BYTES), int(_P)
        tables = []
        for base in _BASES:
            pair = []
            for step in (base, pow(base, -1, p)):
                t = np.ones(size, np.uint64)
                m = 1
                while m < size:
                    k = min(m, size - m)
                    t[m : m + k] = t[:k] * np.uint64(pow(step, m, p)) % _P
                    m += k
                pair.append(t.astype(np.uint32))
            tables.append(pair)
        _powers[:] = tables
    return _powers


class Block:
    """Consecutive documents: ``data`` holds their bytes, document i is ``data[off[i]:off[i+1]]``."""

    def __init__(self, data: np.ndarray, off: np.ndarray, rows: slice):
        self.data, self.off, self.rows, self.n = data, off, rows, len(off) - 1
        self._prefix: list[np.ndarray] | None = None

    def lowered(self) -> Block:
        return Block(LOWER[self.data], self.off, self.rows)

    @property
    def prefix(self) -> list[np.ndarray]:
        if self._prefix is None:
            n = len(self.data)
            self._prefix = []
            for value, (power, _) in zip(_VALUES, _power_tables(n + 1)):
                s = np.zeros(n + 1, np.uint64)
                for i in range(0, n, _STRIDE):  # some at a time, which stay in the processor's cache
                    v = value[self.data[i : i + _STRIDE]]
                    v *= power[i : i + len(v)]
                    high = v >> _P_BITS
                    v &= _P
                    v += high
                    part = s[i + 1 : i + 1 + len(v)]
                    np.cumsum(v, out=part)
                    part += s[i]
                self._prefix.append(s)
        return self._prefix

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Fingerprints of the slices [start, end)."""
        both = []
        for s, (_, inverse) in zip(self.prefix, _power_tables(len(self.data) + 1)):
            h = _fold(_fold(_fold(_fold(s[end] - s[start])) * inverse[start]))
            both.append(np.where(h >= _P, h - _P, h))
        return mix(((both[0] << _P_BITS) | both[1]) ^ ((end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))

    def grams(self, k: int) -> np.ndarray:
        """Fingerprints of all k-byte strings by start, k up to ``SHORT`` (document borders are not looked at)."""
        assert k <= SHORT
        n = len(self.data) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        value = _BYTE64[self.data]
        h, width = value, 1  # of strings of ``width`` bytes, put together from halves
        out, done = np.zeros(n, np.uint64), 0
        rest = k
        while rest:
            if rest & 1:
                out += h[done : done + n] * np.uint64(pow(_BASE64, done, 1 << 64))
                done += width
            rest >>= 1
            if rest:
                h = h[:-width] + h[width:] * np.uint64(pow(_BASE64, width, 1 << 64))
                width *= 2
        return mix(out)

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of ``inside`` that do not cross documents: starts, ends, and per document the first run's index."""
        n = len(inside)
        if not n:
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(self.n + 1, np.int64)
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
        at = self.off[:-1][self.off[:-1] < n]
        before[at] = True
        at = self.off[1:] - 1
        after[at[at >= 0]] = True
        start, end = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
        return start, end, np.searchsorted(start, self.off)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.runs(~IS_SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slices between line feeds, empty ones included; a document of no bytes has one empty line."""
        cut = np.flatnonzero(self.data == 10)
        owner = np.searchsorted(self.off, cut, "right") - 1
        doc = np.concatenate([np.arange(self.n), owner])
        start = np.concatenate([self.off[:-1], cut + 1])
        end = np.concatenate([cut, self.off[1:]])
        order = np.lexsort((start, doc))
        start, doc = start[order], doc[order]
        order = np.lexsort((end, np.concatenate([owner, np.arange(self.n)])))
        return start, end[order], np.searchsorted(doc, np.arange(self.n + 1))

    def doc_of(self, first: np.ndarray) -> np.ndarray:
        """Document of each item, from the per-document index of first items."""
        return np.repeat(np.arange(self.n), np.diff(first))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n, buf = len(column), column.buffers()
    off = np.frombuffer(buf[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(buf[2], np.uint8) if buf[2] is not None else np.zeros(0, np.uint8)
    return data, off


def tidy() -> None:
    """Give freed memory back to the system, which allocators keep otherwise; workers live as long as the executor."""
    global _trim
    pa.default_memory_pool().release_unused()
    if _trim is None:
        try:
            _trim = ctypes.CDLL(None).malloc_trim
        except (OSError, AttributeError, TypeError):  # another C library
            _trim = lambda _: 0
    _trim(0)


_trim: Callable[[int], int] | None = None


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Documents of a column in blocks of about ``limit`` bytes."""
    data, off = utf8(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield Block(data[off[i] : off[j]], off[i : j + 1] - off[i], slice(i, j))
        i = j
    if len(data) >= limit:
        tidy()


def shingles(word: np.ndarray, first: np.ndarray, k: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of k-word windows and the per-document first index.

    ``whole``: a document with 1 to k-1 words has its whole sequence as one shingle.
    """
    n = np.diff(first)
    count = np.maximum(n - k + 1, (n > 0).astype(n.dtype) if whole else 0)
    out_first = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(out_first[-1]) - np.repeat(out_first[:-1] - first[:-1], count)
    width = np.repeat(np.minimum(n, k), count)
    h = np.zeros(len(at), np.uint64)
    for j in range(k):
        take = np.minimum(at + j, len(word) - 1)
        part = mix(word[take] + np.uint64((0x632BE59BD9B4E019 * (j + 1)) & (2**64 - 1))) if len(at) else h
        h += np.where(width > j, part, np.uint64(j + 1))
    return mix(h), out_first


def repeats(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per item: how often its key occurs, and whether an item before it has the key."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.concatenate([[True], k[1:] != k[:-1]])
    group = np.cumsum(new) - 1
    count, later = np.empty(len(key), np.int64), np.empty(len(key), bool)
    count[order], later[order] = np.bincount(group)[group], ~new
    return count, later


def per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` by document."""
    s = np.concatenate([[0], np.cumsum(values)])
    return s[first[1:]] - s[first[:-1]]
