"""LM scoring by cross-entropy difference.

A target and a background model of the same form (interpolated word bigrams over unigrams) share
one vocabulary: the words that occur ``FEWEST`` times or more in the corpus; all others are
one unknown word.  Both are counted over whole texts: the target over documents labelled good, the
background over all documents.  Bigrams that occur less often than that are left to the unigram part.
The floor does not rise with the corpus, so the models grow with the input and are never
held as a whole, neither by the driver nor by a task: rows are dealt into chunks of neighbours,
n-gram counts are summed by hash bucket, and every bucket sends each chunk the counts of the chunk's own n-grams.

A document's score is the mean per-token loss under the background minus that under the
target; above 0 the document is more like the target than like the corpus.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwise.session import written

from . import caches
from . import grams as G
from . import words as W
from .quality import LABEL_ROWS, label_table

FEWEST = 2                # occurrences from which an n-gram has an entry of its own, at any corpus size
WORD_SHARE = 0.0          # no share of the corpus is asked of a word or pair besides
PAIR_SHARE = 0.0
BACKOFF = 0.4             # weight of the unigram part
PRIOR = 1.0               # pseudo-count per unigram, at the background rate, in the target model
BUCKET_GRAMS = 4_000_000  # partial counts that one merging task holds, on average
TOKEN_BYTES = 2           # of compressed text: a low guess, for the number of buckets
CHUNK_BYTES = 16 << 20    # text of the rows that are counted and scored together
ROW_BYTES = 64            # added for every row, so that empty texts fill chunks too

CELLS = "bucket int, chunk long, key binary, context binary, every binary, target binary"
PAIRS = "bucket int, chunk long, key binary, every binary, target binary"
WORDS = "bucket int, chunk long, every binary, target binary, every_left binary, target_left binary, sums array<long>"


def _chunks(batches):
    """One row per chunk of neighbouring rows of one task; the texts are compressed."""
    part, n, held, size = TaskContext.get().partitionId(), 0, [], 0
    codec = pa.Codec("zstd", compression_level=3)

    def chunk():
        ids, target, sizes, raw = zip(*held)
        ids, raw = pa.concat_arrays(ids), np.concatenate(raw)
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + n]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
             pa.array([G.packed(np.concatenate(target))], pa.binary()),
             pa.array([G.packed(np.concatenate(sizes))], pa.binary()),
             pa.array([codec.compress(raw, asbytes=True) if len(raw) else b""], pa.binary())],
            ["chunk", "ids", "target", "sizes", "texts"])

    for batch in batches:
        raw, offsets = W.text_buffer(batch.column("text"))
        chosen = batch.column("target").to_numpy(zero_copy_only=False).astype(np.uint8)
        weight, i = offsets + ROW_BYTES * np.arange(len(offsets)), 0
        while i < batch.num_rows:
            j = min(batch.num_rows, max(i + 1, int(np.searchsorted(weight, weight[i] + CHUNK_BYTES - size, "right")) - 1))
            held.append((batch.column("id")[i:j], chosen[i:j], np.diff(offsets[i:j + 1]), raw[offsets[i]:offsets[j]]))
            size += int(weight[j] - weight[i])
            if j < batch.num_rows or size >= CHUNK_BYTES:
                yield chunk()
                n, held, size = n + 1, [], 0
            i = j
    if held:
        yield chunk()


def _texts(rows, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts of a chunk."""
    sizes, texts = (rows.column(c)[i].as_buffer() for c in ("sizes", "texts"))
    offsets = np.r_[0, np.cumsum(G.unpacked(sizes, np.int64))]
    raw = pa.Codec("zstd").decompress(texts, int(offsets[-1])) if len(texts) else b""
    return np.frombuffer(raw, np.uint8), offsets


def _counted(words: np.ndarray, first: np.ndarray, own: np.ndarray | None, buckets: int, n: int):
    """Distinct words (``n`` = 1) or pairs (2) of a chunk by bucket, in an order that its texts alone decide.

    Keys, first words (of pairs), counts in all rows and in those of the words marked in ``own``, bounds of the buckets.
    """
    keys, at = G.bigram_hashes(words, first) if n == 2 else (words, None)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    every = np.diff(np.r_[start, len(keys)]).astype(np.uint32)
    keys, target, context = keys[start], None, None
    if n == 2:
        context = words[at[order[start]]]
        order = at[order] if own is not None else None
    if own is not None:
        target = np.add.reduceat(own[order], start, dtype=np.uint32) if len(keys) else every
    del order, start, at
    home = (keys % np.uint64(buckets)).astype(np.int32)
    by = np.lexsort((context, home)) if n == 2 else np.argsort(home, kind="stable")    # neighbours are close: they compress
    cuts = np.searchsorted(home[by], np.arange(buckets + 1, dtype=np.int32))
    return *(x if x is None else x[by] for x in (keys, context, every, target)), cuts


def _partial_counts(buckets: int, n: int):
    """Per chunk and bucket: hashes of the words (``n`` = 1) or pairs (2), counted in all and in target rows."""
    def cells(rows, i: int) -> list[pa.Array]:            # its arrays are gone when the next chunk is read
        words, first = W.hash_words(*_texts(rows, i))
        own = np.repeat(G.unpacked(rows.column("target")[i].as_buffer(), np.uint8), np.diff(first))
        keys, context, every, target, cuts = _counted(words, first, own, buckets, n)
        return [G.cells(keys, cuts, n == 1),
                G.cells(context, cuts, True) if n == 2 else pa.array([b""] * buckets, pa.binary()),
                G.cells(every, cuts), G.cells(target, cuts)]

    @caches.task("lm_score")
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield G.filled(pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(buckets, dtype=np.int32)), pa.array([batch.column("chunk")[i].as_py()] * buckets, pa.int64()),
                     *cells(batch, i)], ["bucket", "chunk", "key", "context", "every", "target"]), ["key"])
    return run


class _Merged:
    """Sums over the cells of one bucket, and what each cell gets back: the sums of its own n-grams in their
    order, 0 for those that are not frequent.  The chunk knows the keys, so they are not sent again."""

    def __init__(self, table: pa.Table, floor: float, rising: bool):
        key = G.uncell(table["key"], np.uint64, rising)
        self.bucket, self.chunk = table["bucket"], table["chunk"]
        self.cuts = np.r_[0, np.cumsum(G.cell_sizes(table["key"]))]
        self.order = np.argsort(key, kind="stable")
        key = key[self.order]
        first = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        self.start = np.flatnonzero(first)
        self.key = key[self.start]
        self.every, self.target = (
            np.add.reduceat(G.uncell(table[c], np.uint32)[self.order], self.start, dtype=np.int64)
            if len(key) else np.zeros(0, np.int64) for c in ("every", "target"))
        self.keep = self.every >= floor
        self.entry = np.empty(len(key), np.int64)         # of every n-gram of the cells
        self.entry[self.order] = np.cumsum(first) - 1

    def returned(self, *values: np.ndarray) -> list[pa.Array]:
        return [G.cells(np.where(self.keep, v, 0)[self.entry], self.cuts) for v in (self.every, self.target, *values)]


def _merged_pairs(buckets: int, floor: float):
    """Counts of frequent pairs for the chunks that hold them; sums per first word for the words' buckets."""
    def run(table: pa.Table) -> pa.Table:
        m = _Merged(table, floor, False)
        context = G.uncell(table["context"], np.uint64, True)[m.order[m.start[m.keep]]]
        c, _, e, t = G.summed(context, context, m.every[m.keep], m.target[m.keep])
        home = c % np.uint64(buckets)
        order = np.argsort(home, kind="stable")
        cuts = np.searchsorted(home[order], np.arange(buckets + 1, dtype=np.uint64))
        names = ["bucket", "chunk", "key", "every", "target"]
        to_chunks = pa.table([m.bucket, m.chunk, pa.nulls(len(m.chunk), pa.binary()), *m.returned()], names)
        to_words = pa.RecordBatch.from_arrays(
            [pa.array(np.arange(buckets, dtype=np.int32)), pa.nulls(buckets, pa.int64()),
             *(G.cells(x[order], cuts, x is c) for x in (c, e, t))], names)
        return pa.concat_tables([to_chunks, pa.Table.from_batches([G.filled(to_words, ["key"])])])
    return run


def _merged_words(floor: float):
    """Counts of frequent words, and of the frequent pairs they begin, for the chunks that hold them.

    One more row without chunk: tokens and target tokens, then frequent words and their tokens and target tokens.
    """
    def run(table: pa.Table) -> pa.Table:
        counted = pc.is_valid(table["chunk"])
        sums, m = table.filter(pc.invert(counted)), _Merged(table.filter(counted), floor, True)
        keys = G.uncell(sums["key"], np.uint64, True)
        k, _, e, t = G.summed(keys, keys, G.uncell(sums["every"], np.int64), G.uncell(sums["target"], np.int64))
        left = np.zeros((2, len(m.key)), np.int64)
        left[:, np.searchsorted(m.key, k)] = e, t         # both words of a counted pair are counted
        totals = [m.every.sum(), m.target.sum(), m.keep.sum(), m.every[m.keep].sum(), m.target[m.keep].sum()]
        names = ["bucket", "chunk", "every", "target", "every_left", "target_left", "sums"]
        kind = pa.list_(pa.int64())
        rows = pa.table([m.bucket, m.chunk, *m.returned(*left), pa.nulls(len(m.chunk), kind)], names)
        total = pa.table([pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.binary())] * 4,
                          pa.array([[int(x) for x in totals]], kind)], names)
        return pa.concat_tables([rows, total])
    return run


def _of_chunk(words: np.ndarray, first: np.ndarray, cells: pa.Table, columns: list[str], buckets: int, n: int):
    """The frequent words (``n`` = 1) or pairs (2) of a chunk by ascending key, with what its cells got back."""
    keys = _counted(words, first, None, buckets, n)[0]
    cells = cells.sort_by("bucket")
    got = [G.uncell(cells[c], np.int64) for c in columns]
    if len(got[0]) != len(keys):
        raise ValueError(f"{len(got[0])} counts came back for {len(keys)} n-grams")
    kept = np.flatnonzero(got[0])
    kept = kept[np.argsort(keys[kept])]
    return [keys[kept], *(x[kept] for x in got)]


class Models:
    """Losses under both models, for the words and pairs of one chunk.

    ``sums``: tokens and target tokens of the corpus, words of the vocabulary and their tokens and target tokens.
    """

    def __init__(self, words, pairs, sums):
        self.word, every, target, every_left, target_left = words
        self.pair, *self.pairs = pairs
        tokens, target_tokens, size, known, target_known = sums
        every = np.r_[every, max(tokens - known, 1)].astype(float)
        target = np.r_[target, max(target_tokens - target_known, 0)].astype(float)
        total, target_total, size = known + every[-1], target_known + target[-1], size + 1
        p = every / total
        self.chances = (target + PRIOR * p * size) / (target_total + PRIOR * size), p
        self.singles = np.maximum(target, 1.0), np.maximum(every, 1.0)
        self.left = [np.maximum(1 - (1 - BACKOFF) * np.r_[used, 0] / single, BACKOFF)
                     for used, single in zip((target_left, every_left), self.singles)]

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Index of every word in the vocabulary; the last index is the unknown word."""
        n = len(self.word)
        if not n:
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.searchsorted(self.word, hashes)
        at[at == n] = n - 1
        return np.where(self.word[at] == hashes, at, n)

    def losses(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per-token loss in nats under target and background; a row's first word has no context."""
        ids = self.word_ids(words)
        pairs, at = G.bigram_hashes(words, first)
        out = []
        if len(self.pair) and len(pairs):
            slot = np.searchsorted(self.pair, pairs)
            slot[slot == len(self.pair)] = 0
            known = self.pair[slot] == pairs
        else:
            slot, known = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        before = ids[at]
        for p, single, left, pair in zip(self.chances, self.singles, self.left, self.pairs[::-1]):
            chance = p[ids]
            seen = np.zeros(len(pairs))
            seen[known] = (1 - BACKOFF) * pair[slot[known]] / single[before[known]]
            chance[at + 1] = seen + left[before] * chance[at + 1]
            out.append(-np.log(chance))
        return out[0], out[1]


def model_cells(rows: DataFrame) -> tuple[DataFrame, DataFrame, tuple[int, ...], int]:
    """Counts of the frequent pairs and words, by chunk that holds them, the sums of ``Models``, and the number of buckets.

    From rows of ``_chunks``; the counts are written in the shared folder.
    """
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("texts"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / TOKEN_BYTES / BUCKET_GRAMS))

    pairs = written(rows.mapInArrow(_partial_counts(buckets, 2), CELLS).groupBy("bucket")
                    .applyInArrow(_merged_pairs(buckets, FEWEST), PAIRS), "lm-pairs")
    words = rows.mapInArrow(_partial_counts(buckets, 1), CELLS).drop("context").unionByName(
        pairs.where("chunk is null"))
    words = written(words.groupBy("bucket").applyInArrow(_merged_words(FEWEST), WORDS), "lm-words")
    sums = words.where("chunk is null").agg(*(F.sum(F.col("sums")[i]) for i in range(5))).first()
    return (pairs.where("chunk is not null").drop("key"), words.where("chunk is not null").drop("sums"),
            tuple(x or 0 for x in sums), buckets)


def lm_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_tokens, loss_target, loss_background, score), one row per input row.

    Losses are means in nats, rounded to 6 places.  NULL or blank text: 0 tokens and NULL losses and score.
    Repeated rows score alike.  Without labelled-good documents the target falls back to the background
    unigrams.  Other columns are ignored; an empty table gives an empty result.
    """
    marks = label_table(labels, id_col).where("good").select("label_id", "good")
    few = marks.count() <= LABEL_ROWS
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    rows = base.join(F.broadcast(marks) if few else marks, F.col("id") == F.col("label_id"), "left").select(
        "id", "text", F.coalesce("good", F.lit(False)).alias("target"))
    # chunks must not change between the passes
    chunks = written(rows.mapInArrow(_chunks, f"chunk long, ids array<{kind}>, target binary, sizes binary, texts binary"),
                     "lm-rows", **{"parquet.block.size": 2 * CHUNK_BYTES})
    pairs, words, sums, buckets = model_cells(chunks)

    def run(rows: pa.Table, cells: pa.Table) -> pa.Table:
        rows, of_words = rows.combine_chunks(), pc.is_valid(cells["every_left"])
        raw, offsets = _texts(rows, 0)
        words, first = W.hash_words(raw, offsets)
        models = Models(_of_chunk(words, first, cells.filter(of_words),
                                  ["every", "target", "every_left", "target_left"], buckets, 1),
                        _of_chunk(words, first, cells.filter(pc.invert(of_words)), ["every", "target"], buckets, 2), sums)
        parts = []
        for i, j in W.row_chunks(offsets):
            here = first[i:j + 1] - first[i]
            target, background = models.losses(words[first[i]:first[j]], here)
            parts.append((np.diff(here), G.row_sums(target, here), G.row_sums(background, here)))
        n, a, b = (np.concatenate(x) for x in zip(*parts))
        none = n == 0
        n1 = np.maximum(n, 1)
        cols = [pa.array(np.round(x / n1, 6).astype(float), mask=none) for x in (a, b, b - a)]
        return pa.Table.from_arrays([rows["ids"].chunk(0).flatten(), pa.array(n.astype(np.int64)), *cols],
                                    ["id", "n_tokens", "loss_target", "loss_background", "score"])

    cells = words.unionByName(pairs, allowMissingColumns=True)
    return (chunks.select("chunk", "ids", "sizes", "texts").groupBy("chunk").cogroup(cells.groupBy("chunk"))
            .applyInArrow(run, f"id {kind}, n_tokens long, loss_target double, loss_background double, score double")
            .withColumnRenamed("id", id_col))
