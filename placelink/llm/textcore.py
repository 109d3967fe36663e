"""Whole-batch text kernels: words of many texts at once, straight from Arrow's offset and data buffers.

Nothing here runs once per row or word in Python; memory is bounded by slicing a batch into pieces of at most
``SLICE_BYTES`` (a single longer text makes a piece of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
U = np.uint64

#: Bytes that part words: the blank and \x09 to \x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20_240_607))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_STEP = U(0x9E3779B97F4A7C15)


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose texts have at most ``limit`` bytes, or one row."""
    _, at = texts(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield batch.slice(i, min(j, n) - i)
        i = j


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x = x * U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers)), _STEP, np.uint64)
        grown[0] = U(1)
        _powers = np.multiply.accumulate(grown)
    return _powers


class Words:
    """Tokens of many texts: ``hash`` (uint64), ``doc`` (index of the text), ``start`` and ``end`` (bytes), ``first`` (each text's first token; one more at the end)."""

    def __init__(self, data: np.ndarray, at: np.ndarray, kinds: np.ndarray | None = None, lower: bool = True):
        """kinds: a class for each byte, 0 for what parts tokens; a token is a longest run of one class. By default words parted by SPACE."""
        n = len(at) - 1
        kind = (kinds if kinds is not None else np.where(SPACE, 0, 1).astype(np.uint8))[data]
        edge = np.ones(len(data) + 1, bool)
        if len(data):
            edge[1:-1] = kind[1:] != kind[:-1]
        edge[at] = True
        cut = np.flatnonzero(edge)
        start, end = cut[:-1], cut[1:]
        full = kind[start] != 0 if len(data) else np.zeros(0, bool)
        self.start, self.end = start[full], end[full]
        self.kind = kind[self.start] if len(data) else np.zeros(0, np.uint8)
        self.first = np.searchsorted(self.start, at)
        self.doc = np.repeat(np.arange(n), np.diff(self.first))
        if len(self.start):
            length = self.end - self.start
            inside = np.flatnonzero(kind != 0)
            begin = np.concatenate([[0], np.cumsum(length)[:-1]])
            place = np.arange(len(inside)) - np.repeat(begin, length)
            raw = data[inside]
            terms = _BYTE[LOWER[raw] if lower else raw] * powers(int(length.max()))[place]
            self.hash = mixed(np.add.reduceat(terms, begin) + length.astype(np.uint64) * _STEP)
            self._terms = terms, place, begin, length
        else:
            self.hash = np.zeros(0, np.uint64)

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of the first ``size`` bytes of each longer word: the back-off for forms of a stem that training did not see."""
        if not len(self.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        terms, place, begin, length = self._terms
        long = np.flatnonzero(length > size)
        return long, mixed(np.add.reduceat(np.where(place < size, terms, U(0)), begin)[long] + U(size) * _BYTE[0])

    def grams(self, offsets: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first word, hash) of the grams made of the words at ``offsets`` from each place, within one text. (0, 1) is a bigram, (0, 2) a skip-gram."""
        reach = offsets[-1]
        n = len(self.hash) - reach
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        place = np.flatnonzero(self.doc[:n] == self.doc[reach:])
        out = np.full(len(place), U(len(offsets) * 1000 + reach), np.uint64)
        for k in offsets:
            out = (out ^ self.hash[place + k]) * U(0xD6E8FEB86659FD93)
            out ^= out >> U(32)
        return place, mixed(out)


def distinct_in(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, key, count) of the distinct pairs, by doc and then key."""
    if not len(doc):
        return doc, key, np.zeros(0, np.int64)
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])]))
    return d[new], k[new], np.diff(np.append(new, len(d)))
