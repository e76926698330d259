"""Per-row sums over hashed word n-grams, and n-gram counts sent as sorted chunks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def bigram_hashes(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every pair of neighbouring words of one row, and the index of its first word."""
    from .words import shingle_hashes

    pairs = shingle_hashes(words, 2)
    inside = np.ones(len(pairs), dtype=bool)
    cut = first[1:-1]                       # a row's last word has no partner in the next row
    inside[cut[(cut > 0) & (cut <= len(pairs))] - 1] = False
    at = np.flatnonzero(inside)
    return pairs[at], at


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each row's range ``first[i]:first[i + 1]``; 0 for an empty range.

    Every row is summed by itself, so equal rows get equal sums wherever they stand.
    """
    out = np.zeros(len(first) - 1, dtype=np.float64)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, first[:-1][full])
    return out


def summed(keys: np.ndarray, carried: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys, the value that each key carries, and the sums of its counts."""
    order = np.argsort(keys)
    keys = keys[order]
    if not len(keys):
        return (keys, carried, *counts)
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return (keys[start], carried[order[start]], *(np.add.reduceat(c[order], start) for c in counts))


def packed(values: np.ndarray, rising: bool = False) -> bytes:
    """Numbers as their byte planes, compressed, after their count; nothing for no numbers.

    Small numbers take little, and so do ascending ones (``rising``: differences are stored).
    """
    if not len(values):
        return b""
    if rising:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return len(values).to_bytes(4, "little") + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def unpacked(cell: bytes, dtype, rising: bool = False) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    n = int.from_bytes(cell[:4], "little")
    if not n:
        return np.zeros(0, dtype)
    planes = np.frombuffer(pa.Codec("zstd").decompress(memoryview(cell)[4:], n * size), np.uint8)
    values = np.ascontiguousarray(planes.reshape(size, n).T).view(dtype).ravel()
    return np.cumsum(values, dtype=dtype) if rising else values


def cells(values: np.ndarray, cuts: np.ndarray, rising: bool = False) -> pa.Array:
    """A binary column; cell i holds the slice ``cuts[i]:cuts[i + 1]``."""
    bounds = cuts.tolist()
    return pa.array([packed(values[i:j], rising) for i, j in zip(bounds, bounds[1:])], pa.binary())


def cell_sizes(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers in each cell."""
    return np.array([int.from_bytes(x[:4], "little") for x in column.to_pylist()], np.int64)


def uncell(column: pa.ChunkedArray, dtype, rising: bool = False) -> np.ndarray:
    """The numbers of all cells."""
    out, at = np.empty(int(cell_sizes(column).sum()), dtype), 0
    for cell in column.to_pylist():
        part = unpacked(cell, dtype, rising)
        out[at:at + len(part)] = part
        at += len(part)
    return out


def filled(batch: pa.RecordBatch, columns: list[str]) -> pa.RecordBatch:
    """The rows with something in any of the binary columns: with many buckets most cells of a chunk are empty."""
    keep = np.zeros(batch.num_rows, dtype=bool)
    for c in columns:
        keep |= np.diff(np.frombuffer(batch.column(c).buffers()[1], np.int32)[:batch.num_rows + 1]) > 0
    return batch.filter(pa.array(keep))
