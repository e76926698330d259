"""Vectorised words, word hashes and shingle sets of whole texts, for use inside tasks.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09``-``\\x0D``; A-Z may be
lower-cased.  All functions take the raw UTF-8 buffer of an Arrow string column, so no
Python loop runs per word.  Work is cut into windows of about two megabytes at word
boundaries, which bounds memory for very long texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import caches

WINDOW = 1 << 21
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_powers: dict[str, np.ndarray] = {}
caches.remember("words", _powers.clear)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd hash base modulo 2**64 and of its inverse, ``n`` of each."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, WINDOW)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser, so that every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, size: int = 4 * WINDOW) -> Iterator[tuple[int, int]]:
    """Ranges of rows holding about ``size`` bytes each (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a row's first byte always begins a new word."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = SEPARATOR[raw]
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[offsets] = True
    start = ~gap
    start[1:] &= gap[:-1] | first[1:-1]
    end = ~gap
    end[:-1] &= gap[1:] | first[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def hash_words(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the index of each row's first word (length rows + 1)."""
    starts, ends = word_bounds(raw, offsets)
    out = np.empty(len(starts), dtype=np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + WINDOW, side="right")))
        lo, hi = int(starts[a]), int(ends[b - 1])
        up, down = powers(hi - lo)
        part = LOWER[raw[lo:hi]] if lower else raw[lo:hi]
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=total[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        a = b
    return out, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words; entry ``i`` starts at word ``i``."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i:i + n]
    return mix(out)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct ``k``-word shingles of every row.

    A row of fewer than ``k`` words has its whole sequence as its one shingle; a row
    without words has none.
    """
    words, first = hash_words(raw, offsets)
    runs = shingle_hashes(words, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            found = np.sort(runs[a:b - k + 1])
            if len(found) > 1:
                keep = np.empty(len(found), dtype=bool)
                keep[0] = True
                np.not_equal(found[1:], found[:-1], out=keep[1:])
                found = found[keep]
            yield found
        elif b > a:
            yield mix(shingle_hashes(words[a:b], b - a) + np.uint64(b - a))
        else:
            yield np.zeros(0, dtype=np.uint64)
