"""Substring dedup by seed and extend: every word covered by a repeated window of words is removed.

Seeds: the hashes of all runs of ``SEED`` words are winnowed, that is, the least of every
``window - SEED + 1`` neighbours is an anchor.  Equal windows have the same anchor at the same place, so a
window can only repeat where its anchor does.  All anchors of the corpus are joined by hash; those met only
once, nearly all of a corpus, end there.

Extension: around an anchor found elsewhere too, the text is extended to both sides to every window
that has this anchor.  The windows of all occurrences of an anchor meet in the anchor's bucket, where equal
ones are counted, so no pairs of occurrences are made, however many there are.  Runs of repeated windows are
the maximal repeats of ``window`` words or more; a document loses their words.

Documents are dealt into chunks of neighbours, written once.  A chunk sends every distinct anchor or window
once, so a passage of a third of all documents costs an entry per chunk, and is sent back one bit per entry.
Anchors and windows are 64-bit hashes; a window is only compared with windows of its anchor's bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwise.session import scratch_path, ship

from . import words as W

WINDOW = 35               # words of the shortest repeat
SEED = 16                 # words of an anchor
CHUNK_BYTES = 8 << 20     # text of the rows that are worked on together
ROW_BYTES = 64            # added for every row, so that empty texts fill chunks too
ANCHOR_BUCKET = 64 << 20  # bytes of text whose anchors one task joins, on average
WINDOW_BUCKET = 24 << 20  # bytes of text whose windows one task counts, on average

ROWS = "chunk long, row long, id long, text string, size long"
ASKED = "bucket int, chunk long, keys binary, more binary"
ANSWER = "chunk long, bucket int, bits binary"


def _dealt(batches):
    """The rows with the number of their chunk (neighbours of one task) and their place."""
    part, held, row = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        _, offsets = W.text_buffer(batch.column("text"))
        n = len(offsets) - 1
        begin = held + offsets[:-1] + ROW_BYTES * np.arange(n)
        held += int(offsets[-1]) + ROW_BYTES * n
        yield pa.RecordBatch.from_arrays(
            [pa.array((part << 32) + begin // CHUNK_BYTES), pa.array(np.arange(row, row + n)), *batch.columns,
             pa.array(np.diff(offsets) + ROW_BYTES)], ["chunk", "row", "id", "text", "size"])
        row += n


def run_hashes(words: np.ndarray, n: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """Hash of every run of ``n`` words, put together from runs of powers of two; entry i starts at word i."""
    if n not in known:
        half = 1 << (n - 1).bit_length() - 1
        a, b = run_hashes(words, half, known), run_hashes(words, n - half, known)
        size = max(len(words) - n + 1, 0)
        known[n] = W.mix(a[:size] * np.uint64(0xD6E8FEB86659FD93) + b[half:half + size] + np.uint64(n))
    return known[n]


def _slid(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out, have = pick(out[:-step], out[step:]), have + step
    return out


class Seeds:
    """Words, anchors and windows of the rows of one chunk.

    ``own[p]``: the anchor of the window that begins at word p, 0 where no window of one row does.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, window: int, seed: int):
        self.words, self.first = W.hash_words(raw, offsets, lower=False)
        self.window, self.span, self.known = window, window - seed + 1, {1: self.words}
        n = len(self.words)
        self.own = np.zeros(max(n - window + 1, 0), np.uint64)
        if not len(self.own):
            self.grams = self.own
            return
        self.grams = run_hashes(self.words, seed, self.known) | np.uint64(1)
        self.own[:] = _slid(self.grams, self.span, np.minimum)
        inside = np.zeros(n + 1, np.int32)                 # windows that lie within one row
        size = np.diff(self.first)
        long = size >= window
        np.add.at(inside, self.first[:-1][long], 1)
        np.add.at(inside, self.first[1:][long] - window + 1, -1)
        self.own[np.cumsum(inside)[:len(self.own)] == 0] = 0

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors, ascending, and whether each has two places or more here."""
        if not len(self.own):
            return self.own, np.zeros(0, bool)
        pad = np.zeros(self.span - 1, np.uint64)
        most = _slid(np.concatenate([pad, self.own, pad]), self.span, np.maximum)
        value, count = np.unique(self.grams[self.grams == most], return_counts=True)
        return value, count > 1

    def windows(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the windows whose anchor is one of ``shared`` (ascending)."""
        if not len(shared) or not len(self.own):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.searchsorted(shared, self.own)
        at[at == len(shared)] = 0
        place = np.flatnonzero(shared[at] == self.own)
        return place, run_hashes(self.words, self.window, self.known)[place]


def _asked(keys: np.ndarray, more: np.ndarray, home: np.ndarray, chunk: int) -> pa.RecordBatch:
    """The keys of one chunk by bucket, for the buckets that get any; a bit says that a key is there twice or more."""
    order = np.argsort(home, kind="stable")
    keys, more, home = keys[order], more[order], home[order]
    start = np.flatnonzero(np.r_[True, home[1:] != home[:-1]]) if len(home) else np.zeros(0, np.int64)
    ends = np.r_[start[1:], len(home)] if len(home) else start
    return pa.RecordBatch.from_arrays(
        [pa.array(home[start].astype(np.int32)), pa.array(np.full(len(start), chunk, np.int64)),
         pa.array([keys[i:j].tobytes() for i, j in zip(start, ends)], pa.binary()),
         pa.array([np.packbits(more[i:j]).tobytes() for i, j in zip(start, ends)], pa.binary())],
        ["bucket", "chunk", "keys", "more"])


def _repeated(table: pa.Table) -> pa.Table:
    """One bucket: for every chunk a bit per distinct key it sent, ascending, set if the key is met twice or more in all."""
    sizes = pc.binary_length(table["keys"]).to_numpy() // 8
    keys = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint64)
    more = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n)
                           for m, n in zip(table["more"].to_pylist(), sizes.tolist())])
    chunks, of = np.unique(table["chunk"].to_numpy(), return_inverse=True)
    of = np.repeat(of, sizes)
    order = np.lexsort((of, keys))
    keys, of, more = keys[order], of[order], more[order]
    first = np.r_[True, keys[1:] != keys[:-1]]
    start = np.flatnonzero(first)
    many = (np.diff(np.r_[start, len(keys)]) > 1) | (np.add.reduceat(more.astype(np.int64), start) > 0)
    met = many[np.cumsum(first) - 1]
    once = first | np.r_[True, of[1:] != of[:-1]]          # parts of a chunk may have sent a key each
    back = np.flatnonzero(once)[np.argsort(of[once], kind="stable")]
    ends = np.cumsum(np.bincount(of[once], minlength=len(chunks)))
    cells = [np.packbits(met[back[i:j]]).tobytes() for i, j in zip(np.r_[0, ends[:-1]], ends)]
    return pa.table({"chunk": pa.array(chunks), "bucket": pa.array(np.full(len(chunks), table["bucket"][0].as_py(), np.int32)),
                     "bits": pa.array(cells, pa.binary())})


def _answered(keys: np.ndarray, home: np.ndarray, answers: pa.Table) -> np.ndarray:
    """The answer to every key: the keys of a bucket were sent in their order here."""
    order = np.argsort(home, kind="stable")
    cell = dict(zip(answers["bucket"].to_pylist(), answers["bits"].to_pylist()))
    bucket, size = np.unique(home, return_counts=True)
    out = np.empty(len(keys), bool)
    out[order] = np.concatenate([np.unpackbits(np.frombuffer(cell[b], np.uint8), count=n)
                                 for b, n in zip(bucket.tolist(), size.tolist())] or [np.zeros(0)]) > 0
    return out


def _home(anchors: np.ndarray, buckets: int) -> np.ndarray:
    return (W.mix(anchors) % np.uint64(buckets)).astype(np.int64)


def _distinct(place: np.ndarray, hashes: np.ndarray, own: np.ndarray):
    """Distinct windows, ascending, whether each is there twice or more, their anchors, and the window at every place."""
    keys, at, which, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    return keys, count > 1, own[place[at]], which


def _seed_chunks(window: int, seed: int, buckets: int):
    """Anchors by bucket, chunk by chunk; a chunk whose rows come in several batches sends every part for itself."""
    def run(batches):
        for batch in batches:
            raw, offsets = W.text_buffer(batch.column("text"))
            chunk = batch.column("chunk").to_numpy()
            cut = np.flatnonzero(np.diff(chunk)) + 1
            for i, j in zip(np.r_[0, cut].tolist(), np.r_[cut, len(chunk)].tolist()):
                if i < j:
                    value, more = Seeds(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], window, seed).anchors()
                    yield _asked(value, more, _home(value, buckets), int(chunk[i]))
    return run


class _Chunk:
    """One chunk with the anchors found elsewhere too, and the windows around them."""

    def __init__(self, rows: pa.Table, answers: pa.Table, window: int, seed: int, buckets: int):
        self.rows = rows.sort_by("row")
        self.raw, self.offsets = W.text_buffer(self.rows["text"])
        self.seeds = Seeds(self.raw, self.offsets, window, seed)
        value, _ = self.seeds.anchors()
        shared = value[_answered(value, _home(value, buckets), answers)]
        self.place, hashes = self.seeds.windows(shared)
        self.shared, self.window = shared, window
        self.keys, self.more, self.anchor, self.which = _distinct(self.place, hashes, self.seeds.own)


def _window_chunks(window: int, seed: int, anchor_buckets: int, window_buckets: int):
    """Windows around shared anchors, by the anchor's bucket."""
    def run(key, rows: pa.Table, answers: pa.Table) -> pa.Table:
        c = _Chunk(rows, answers, window, seed, anchor_buckets)
        return pa.Table.from_batches([_asked(c.keys, c.more, _home(c.anchor, window_buckets), key[0].as_py())])
    return run


def _kept(window: int, seed: int, anchor_buckets: int, window_buckets: int):
    """Rows with the words and the text that are left, after the repeats' words are gone."""
    def run(key, rows: pa.Table, answers: pa.Table) -> pa.Table:
        second = pc.equal(answers["step"], 2)
        c = _Chunk(rows, answers.filter(pc.invert(second)), window, seed, anchor_buckets)
        hit = _answered(c.keys, _home(c.anchor, window_buckets), answers.filter(second))
        n, first = len(c.seeds.words), c.seeds.first
        edge = np.zeros(n + 1, np.int64)
        found = c.place[hit[c.which]]
        edge[found] += 1
        edge[found + window] -= 1
        gone = np.cumsum(edge[:n]) > 0
        n_words = np.diff(first)
        removed = np.diff(np.r_[0, np.cumsum(gone)][first])
        starts, ends = W.word_bounds(c.raw, c.offsets)
        text = _joined(c.raw, starts, ends, first, ~gone)
        return pa.table({"id": c.rows["id"], "n_words": pa.array(n_words), "n_removed": pa.array(removed), "kept": text})
    return run


def _joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The kept words of every row, joined by one space."""
    at = np.flatnonzero(keep)
    size = ends[at] - starts[at] + 1                       # with a space before each word
    total = int(size.sum())
    begin = np.cumsum(size) - size
    out = np.full(total, 0x20, np.uint8)
    word = np.ones(total, bool)
    word[begin] = False
    mark = np.zeros(len(raw) + 1, np.int8)
    mark[starts[at]] += 1
    np.subtract.at(mark, ends[at], 1)
    out[word] = raw[np.cumsum(mark[:-1], dtype=np.int8) > 0]
    per_row = np.diff(np.searchsorted(at, first))
    bounds = np.r_[begin, total][np.searchsorted(at, first)]
    cut = np.ones(total, bool)
    cut[bounds[:-1][per_row > 0]] = False                  # no space before a row's first word
    lengths = np.diff(bounds) - (per_row > 0)
    offsets = np.r_[0, np.cumsum(lengths)].astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(out[cut])).cast(pa.string())


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(id, n_words, n_removed, kept) per row: the text without the words of repeated windows.

    A word is a run of characters other than ``\\x20`` and ``\\x09``-``\\x0D``, unchanged.  Every word covered by
    a window of ``window`` words whose sequence starts anywhere else too, in this row or another, is removed,
    judged on the input; the kept words are joined by one space.

    NULL, empty and blank texts have no words; a text shorter than a window loses none.  Repeated rows, with
    NULL or equal ids too, are rows like others: of equal long texts nothing is left.  Windows do not reach from one
    row into the next.  An empty table gives an empty result; other columns are ignored.
    """
    if not 0 < seed <= window:
        raise ValueError("an anchor has at least one word and at most a window's")
    spark = docs.sparkSession
    ship(spark)
    path = scratch_path(spark, "repeat-rows")
    (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
     .mapInArrow(_dealt, ROWS).write.option("compression", "zstd").parquet(path))
    rows = spark.read.schema(ROWS).parquet(path)
    size = rows.agg(F.sum("size")).first()[0] or 0
    few, many = max(1, -(-size // ANCHOR_BUCKET)), max(1, -(-size // WINDOW_BUCKET))

    def answers(asked: DataFrame, name: str) -> DataFrame:
        at = scratch_path(spark, name)
        asked.groupBy("bucket").applyInArrow(_repeated, ANSWER).write.parquet(at)
        return spark.read.schema(ANSWER).parquet(at)

    texts = rows.select("chunk", "row", "id", "text")
    anchors = answers(texts.select("chunk", "text").mapInArrow(_seed_chunks(window, seed, few), ASKED), "repeat-anchors")
    windows = answers(texts.groupBy("chunk").cogroup(anchors.groupBy("chunk"))
                      .applyInArrow(_window_chunks(window, seed, few, many), ASKED), "repeat-windows")
    both = anchors.withColumn("step", F.lit(1)).unionByName(windows.withColumn("step", F.lit(2)))
    return (texts.groupBy("chunk").cogroup(both.groupBy("chunk"))
            .applyInArrow(_kept(window, seed, few, many), "id long, n_words long, n_removed long, kept string"))
