"""Words of whole texts as numpy arrays, a bounded piece of a batch at a time.

A word is a run of bytes other than space and \\x09-\\x0D; in UTF-8 none of
these bytes is part of another character, so words are found and hashed on
the bytes of an Arrow column without making Python strings.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20  # bytes of text worked on at a time (a longer text is a piece of its own)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE_LOWER = _VALUE.copy()
_VALUE_LOWER[ord("A"):ord("Z") + 1] = _VALUE[ord("a"):ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15  # of every rolling hash: what is hashed differs by its values
_POWERS: list[np.ndarray] = []  # of the running task


def release_memory() -> None:
    """Give freed memory back to the system; allocators would keep it."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def releasing(task):
    """A map function over batches that gives the memory it took back at its
    end: Python workers live on between tasks."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            release_memory()
    return run


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    with np.errstate(over="ignore"):
        z = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """_BASE**i and _BASE**-i (mod 2**64) for i up to n."""
    if _POWERS and _POWERS[0].size > n:
        return _POWERS
    size = max(n + 1, 1 << 16)
    both = []
    for b in (_BASE, pow(_BASE, -1, 2**64)):
        run = np.full(size, b, dtype=np.uint64)
        run[0] = 1
        both.append(np.cumprod(run, dtype=np.uint64))
    if size <= PIECE_BYTES + 1:  # a rare long text's tables are not kept
        _POWERS[:] = both
    return both


def rolling(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of values[begin:end] for every pair: a difference of
    prefix sums, shifted so that the place does not matter."""
    up, down = _powers(values.size)
    prefix = np.zeros(values.size + 1, dtype=np.uint64)
    np.cumsum(values * down[:values.size], out=prefix[1:])
    return mix((prefix[end] - prefix[begin]) * up[begin] + (end - begin).astype(np.uint64))


@dataclass
class Piece:
    """Some rows of a batch. ``first`` has, per row, its first word in
    ``hashes`` (one more entry at the end)."""
    rows: slice
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[slice]:
    """Consecutive rows of at most ``limit`` bytes, or one longer row."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield slice(at, to)
        at = to


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte ranges of all words, and per row its first."""
    if data.size == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(data.size + 1, dtype=bool)
    edge[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    ends = word
    ends[:-1] &= ~word[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def pieces(column, lower: bool = False) -> Iterator[Piece]:
    """Hashed words of a string column, piece by piece; with ``lower``, A-Z
    count as a-z."""
    data, offsets = text_bytes(column)
    table = _VALUE_LOWER if lower else _VALUE
    for rows in row_slices(offsets):
        own = offsets[rows.start:rows.stop + 1]
        body = data[own[0]:own[-1]]
        start, end, first = word_bounds(body, own - own[0])
        yield Piece(rows, first, rolling(table[body], start, end) if start.size else np.zeros(0, np.uint64))


def windows(piece: Piece, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, rows' counts) of all runs of ``width`` words inside a row, in
    order."""
    n = np.maximum(piece.counts - (width - 1), 0)
    begin = np.repeat(piece.first[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    if begin.size == 0:
        return np.zeros(0, np.uint64), n
    return rolling(piece.hashes, begin, begin + width), n


def whole_rows(piece: Piece, rows: np.ndarray) -> np.ndarray:
    """Hash of all words of the given rows."""
    return rolling(piece.hashes, piece.first[rows], piece.first[rows + 1])
