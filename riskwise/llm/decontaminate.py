"""Benchmark decontamination by the q-gram lemma in diagonal bands, with banded alignment.

Text and passages are compared after lower-casing and white-space folding.  A passage of
length m may differ by ``k = floor(rate * m)`` edits.  Cut into disjoint q-grams, it has
m // q of them and one edit destroys at most one, so any occurrence keeps at least
m // q - k of them on at most k + 1 neighbouring diagonals.  Per passage, the shared q-grams are
counted in bands of 2 (k + 1) diagonals, each overlapping the next by half, so that one
band holds them all.  Bands that reach the bound are verified by banded alignment.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riskwise.session import scratch_path

from . import caches
from .graph import saved

RATE = 0.1                    # edits per passage character
Q = 6
BLOCK_CHARS = 4_000_000       # passage characters held by one pass over the documents
PIECE = 1 << 16               # characters of texts that are counted together
_BASE = 0x9E3779B97F4A7C15
_FAR = 1 << 20


def folded(text: str) -> str:
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def gram_hashes(c: np.ndarray, q: int) -> np.ndarray:
    """Hash of the ``q`` characters from each position on."""
    n = len(c) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h, span = c, 1
    while span * 2 <= q:
        h = h[:-span] * np.uint64(pow(_BASE, span, 1 << 64)) + h[span:]
        span *= 2
    out = h[:n]
    for at in range(span, q):          # append the rest character by character
        out = out * np.uint64(_BASE) + c[at:at + n]
    return out * np.uint64(0xD6E8FEB86659FD93)


class Passages:
    """The q-gram index of one block of passages; small enough to ship with a task."""

    def __init__(self, items: list[tuple[object, str]], q: int = Q, rate: float = RATE):
        self.ids, self.texts, self.q = [], [], q
        for key, text in items:
            t = folded(text or "")
            if len(t) >= q:            # shorter passages are not passages: they occur anywhere
                self.ids.append(key)
                self.texts.append(t)
        self.length = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.edits = np.minimum((self.length * rate).astype(np.int64), np.maximum(self.length // q - 1, 0))
        self.bound = self.length // q - self.edits
        self.width = self.edits + 1
        grams, owner, offset = [], [], []
        for p, t in enumerate(self.texts):
            at = np.arange(0, len(t) - q + 1, q)
            grams.append(gram_hashes(codes(t), q)[at])
            owner.append(np.full(len(at), p))
            offset.append(at)
        gram = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(gram, kind="stable")
        self.owner = np.concatenate(owner)[order] if grams else np.zeros(0, np.int64)
        self.offset = np.concatenate(offset)[order] if grams else np.zeros(0, np.int64)
        self.gram, first, count = np.unique(gram[order], return_index=True, return_counts=True)
        self.first, self.count = first, count
        bits = max(16, int(len(self.gram) * 32).bit_length())
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, dtype=bool)
        self.seen[self.gram >> self.shift] = True
        self.longest = int(self.length.max(initial=0))

    def regions(self, c: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(passage, low, high): diagonals low..high-1 of ``c`` whose band reaches the bound."""
        if not len(self.gram):
            return
        h = gram_hashes(c, self.q)
        at = np.flatnonzero(self.seen[h >> self.shift])
        if not len(at):
            return
        found = h[at]
        slot = np.searchsorted(self.gram, found)
        slot[slot == len(self.gram)] = 0
        hit = self.gram[slot] == found
        at, slot = at[hit], slot[hit]
        if not len(at):
            return
        times = self.count[slot]
        total = int(times.sum())
        entry = np.arange(total) - np.repeat(np.cumsum(times) - times, times) + np.repeat(self.first[slot], times)
        p = self.owner[entry]
        diagonal = np.repeat(at, times) - self.offset[entry] + self.longest
        bands = (len(c) + self.longest) // self.width + 2
        base = np.cumsum(bands) - bands
        cell = base[p] + diagonal // self.width[p]
        # a band is two neighbouring cells; cells of different passages never touch (one spare cell each)
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        cells = cell[start]
        stop = np.r_[start[1:], total]
        joins = np.r_[cells[1:] == cells[:-1] + 1, False]
        owner = p[order][start]
        for first, with_next in ((np.flatnonzero(joins), True), (np.arange(len(cells)), False)):
            end = stop[first + 1] if with_next else stop[first]
            good = end - start[first] >= self.bound[owner[first]]
            for k, e in zip(first[good].tolist(), end[good].tolist()):
                q = int(owner[k])
                # common q-grams can be met again and again: count each of the passage's once
                if len(np.unique(self.offset[entry[order[start[k]:e]]])) >= self.bound[q]:
                    w = int(self.width[q])
                    low = (int(cells[k]) - int(base[q])) * w - self.longest
                    yield q, low, low + 2 * w

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(row, passage, start, end, edits): the best occurrence of every passage in every text.

        Positions are those of the folded text.  Texts are counted together, a NUL between
        them, in pieces of about PIECE characters; a longer text is cut into overlapping pieces.
        """
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        group: list[tuple[int, str]] = []
        size = 0
        for row, text in enumerate(texts):
            t = folded(text) if text else ""
            if len(t) >= self.q:
                group.append((row, t))
                size += len(t) + 1
            if size >= PIECE:
                self._search(group, best)
                group, size = [], 0
        self._search(group, best)
        return [(row, p, a, b, e) for (row, p), (e, a, b) in sorted(best.items())]

    def _search(self, group: list[tuple[int, str]], best: dict) -> None:
        if not group or not self.texts:
            return
        stream = "\0".join(t for _, t in group)
        starts = np.cumsum([0] + [len(t) + 1 for _, t in group])
        # pieces overlap by more than the longest region, so every occurrence lies whole in one
        overlap = 2 * self.longest + 4 * int(self.width.max()) + self.q
        step = max(2 * PIECE, 4 * overlap)
        for s in range(0, max(1, len(stream) - overlap), step):
            c = codes(stream[s:s + step + overlap])
            for p, low, high in self.regions(c):
                m, k = int(self.length[p]), int(self.edits[p])
                lo, hi = s + max(0, low - k), s + min(len(c), high + m + k)
                for g in range(int(np.searchsorted(starts, lo, side="right")) - 1, len(group)):
                    if starts[g] >= hi:
                        break
                    row, t = group[g]
                    key, origin = (row, p), int(starts[g])
                    if best.get(key, (1,))[0] == 0 or min(hi - origin, len(t)) - max(lo - origin, 0) < m - k:
                        continue
                    at = t.find(self.texts[p], max(lo - origin, 0), hi - origin)
                    if at >= 0:
                        best[key] = (0, at, at + m)
                        continue
                    a, b = max(lo - origin, 0), min(hi - origin, len(t))
                    shift = s - origin - a
                    got = align(codes(self.texts[p]), codes(t[a:b]), low + shift, high + shift, k)
                    if got and (found := (got[0], got[1] + a, got[2] + a)) < best.get(key, (m, 0, 0)):
                        best[key] = found


def _rows(pattern: np.ndarray, text: np.ndarray, low: int, width: int, first: np.ndarray) -> np.ndarray:
    """Last row of the banded edit-distance table; entry d is diagonal ``low + d``."""
    index = np.arange(width)
    row = np.minimum.accumulate(first - index) + index
    m = len(pattern)
    padded = np.full(m + width + 1, np.iinfo(np.uint64).max, dtype=np.uint64)
    a, b = max(0, low), min(len(text), low + m + width)
    if b > a:
        padded[a - low:b - low] = text[a:b]
    skip = np.full(width, _FAR, dtype=np.int64)
    for j in range(m):
        same = row + (padded[j:j + width] != pattern[j])
        if j + low < 0:                                  # no text before position 0
            same[:-(j + low)] = _FAR
        np.add(row[1:], 1, out=skip[:-1])                # passage character without a partner
        np.minimum(same, skip, out=row)
        row -= index
        np.minimum.accumulate(row, out=row)              # text characters without a partner
        row += index
    return row


def align(pattern: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best occurrence near diagonals low..high-1, or None.

    Occurrences may start and end anywhere in the text; the band is widened by
    ``edits`` on both sides, which is as far as an accepted path can leave it.
    """
    low, high = low - edits, high + edits
    width, m, n = high - low, len(pattern), len(text)
    at = np.arange(width) + low
    first = np.where((at >= 0) & (at <= n), 0, _FAR)
    last = _rows(pattern, text, low, width, first)
    ends = at + m
    last = np.where((ends >= 0) & (ends <= n), last, _FAR)
    d = int(last.argmin())
    if last[d] > edits:
        return None
    end = int(ends[d])
    back = text[:end][::-1]
    around = np.arange(2 * edits + 1) - edits            # diagonals of the reversed text
    first = np.where(around == 0, 0, _FAR)
    first = np.where(around > 0, around, first)
    last = _rows(pattern[::-1], back, -edits, 2 * edits + 1, first)
    size = around + m
    last = np.where((size >= 0) & (size <= end), last, _FAR)
    d = int(last.argmin())
    return int(last[d]), end - int(size[d]), end


def passage_key(text: Column) -> Column:
    """What stands for a passage's text in an index and its results."""
    return F.xxhash64(text.cast("string"))


def passage_blocks(benchmark: DataFrame, text_col: str, rate: float) -> Iterator[tuple[Passages, int]]:
    """(index, number of blocks): indexes over the distinct passages, each of about ``BLOCK_CHARS`` characters.

    Repeated passages are reduced to one by Spark first; one block at a time is brought to the driver.
    """
    texts = benchmark.select(F.col(text_col).cast("string").alias("text")).where("text is not null").distinct()
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    keyed = texts.select(passage_key(F.col("text")).alias("key"), "text")
    for b in range(blocks):
        part = keyed if blocks == 1 else keyed.where(F.pmod("key", F.lit(blocks)) == b)
        yield Passages(sorted((r["key"], r["text"]) for r in part.collect()), rate=rate), blocks


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text: str = "text", rate: float = RATE) -> DataFrame:
    """(``id_col``, ``item_col``, start, end, edits): the best occurrence of every passage in every text.

    Positions are code points of the folded text (lower case, one space between words).
    NULL or empty texts have no matches, nor do passages shorter than one q-gram (``Q`` characters); a passage of m
    characters is found with up to ``min(rate * m, m // Q - 1)`` edits.
    Repeated documents or passages match each for itself; a NULL id is carried along.
    Other columns are ignored; if either table is empty, so is the result.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = base.schema["id"].dataType
    schema = f"id {id_type.simpleString()}, key long, start long, `end` long, edits long"
    kinds = [to_arrow_type(id_type), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def searcher(index: Passages):
        @caches.task("decontaminate")
        def run(batches):
            for batch in batches:
                ids = batch.column("id").to_pylist()
                rows = [(ids[row], index.ids[p], a, b, e)
                        for row, p, a, b, e in index.find(batch.column("text").to_pylist())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     ["id", "key", "start", "end", "edits"])
        return run

    path, out = scratch_path(docs.sparkSession, "passages-found"), None
    for index, blocks in passage_blocks(benchmark, item_text, rate):
        out = base.mapInArrow(searcher(index), schema)
        if blocks > 1:                     # a block's matches are written before the next one is built
            out.write.mode("append").parquet(path)
    if blocks > 1:
        out = docs.sparkSession.read.schema(schema).parquet(path)
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_col).alias("item"), passage_key(F.col(item_text)).alias("key"))
    return (out.join(items, "key")
            .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "start", "end", "edits"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text: str = "text", rate: float = RATE) -> DataFrame:
    """The rows, all columns whatever their names, whose text holds no passage.

    NULL and empty texts stay; repeated rows are judged each for itself, texts of any length whole.  An empty benchmark
    removes nothing; an empty table stays empty.
    """
    at = docs.columns.index(text_col)

    def keeper(index: Passages):
        @caches.task("decontaminate")
        def run(batches):
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[row for row, *_ in index.find(batch.column(at).to_pylist())]] = False
                yield batch.filter(pa.array(keep))
        return run

    for index, blocks in passage_blocks(benchmark, item_text, rate):
        docs = docs.mapInArrow(keeper(index), docs.schema)
        if blocks > 1:
            docs = saved(docs)
    return docs
