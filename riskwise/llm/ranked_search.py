"""Ranked lexical search over all documents, with equal bags of terms scored once.

Documents are reduced to the vocabulary of the items searched for: their bag is the vector of term
counts over it.  A score depends on the bag and on the length class ``m`` alone, so documents with equal bag
and ``m`` form a class: they are dealt by hash and grouped by the whole vector, which verifies them.  Every class
is scored once against all items; then it is expanded into its members by ascending id.  No item can return more
than ``limit`` members of one class, so the smallest ``limit`` ids of a class are all it needs; copies beyond
those are left out before the shuffle already.

Corpus statistics (documents, terms, documents per term) are counted over all documents.  All scores are
64-bit integers.  Items come in blocks with a bounded number of terms, one block after the other; documents are
never collected, and of each task only the best ``limit`` per item are shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskwise.session import scratch_path, ship

from . import words as W

ITEM_TERMS = 200_000      # terms, counted per item, of one block of items, on average
CELLS = 1 << 22           # scores, or single contributions to them, held at a time

#: Fixed value: terms are maximal runs of characters outside this set's complement (ASCII that is no letter or digit).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP = np.zeros(256, dtype=bool)
_GAP[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

BAGS = "id long, n long, bag binary"
FOUND = "item int, item_id long, id long, score long"
_PAIR = np.dtype([("term", "<i4"), ("tf", "<i4")])


def terms_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All terms of the rows, A-Z in lower case, and the index of every row's first one (length rows + 1)."""
    gap = np.append(_GAP[raw], True)
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True                                   # a row's first byte begins a new term
    before = np.concatenate([[True], gap[:-1]]) | edge
    starts = np.flatnonzero(~gap & before)
    inside = ~gap[:-1]
    ends = np.flatnonzero(inside & (gap[1:] | edge[1:])) + 1
    bounds = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    text = W.LOWER[raw[inside]]
    return (pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(text)),
            np.searchsorted(starts, offsets))


def _bags(vocabulary: pa.LargeStringArray):
    """Term total and bag of every document: pairs of term number and count, by ascending term number."""
    size = len(vocabulary)

    def run(batches):
        for batch in batches:
            raw, offsets = W.text_buffer(batch.column("text"))
            for i, j in W.row_chunks(offsets):
                terms, first = terms_of(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                code = pc.index_in(terms, value_set=vocabulary)
                known = code.is_valid().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(j - i), np.diff(first))[known]
                key, tf = np.unique(row * size + code.drop_null().to_numpy(), return_counts=True)
                pairs = np.empty(len(key), _PAIR)
                pairs["term"], pairs["tf"] = key % size, tf
                cuts = 8 * np.searchsorted(key, np.arange(j - i + 1) * size)
                bags = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(cuts.astype(np.int32)),
                                                                  pa.py_buffer(pairs.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column("id")[i:j], pa.array(np.diff(first)), bags],
                                                 ["id", "n", "bag"])
    return run


def _pairs(bags: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of all bags, and the number of pairs in each."""
    return (np.frombuffer(b"".join(bags.to_pylist()), _PAIR),
            pc.binary_length(bags).to_numpy(zero_copy_only=False).astype(np.int64) // 8)


def _frequencies(size: int):
    """Documents of one task that hold each term."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_pairs(batch.column("bag"))[0]["term"], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "df"])
    return run


class _Best:
    """The ``limit`` best documents of every item so far: higher scores first, then smaller ids."""

    def __init__(self, items: int, limit: int):
        self.limit = limit
        self.score = [np.zeros(0, np.int64)] * items
        self.id = [np.zeros(0, np.int64)] * items
        self.floor = np.ones(items, np.int64)              # a lower score can't come in any more

    def add(self, scores: np.ndarray, first: np.ndarray, members: np.ndarray) -> None:
        """``scores`` (class, item); class c has the ids ``members[first[c]:first[c + 1]]``."""
        for j in np.flatnonzero((scores >= self.floor).any(axis=0)):
            col = scores[:, j]
            at = np.flatnonzero(col >= self.floor[j])
            if len(at) > self.limit:                       # every class has a member: lower classes have no place
                at = at[col[at] >= np.partition(col[at], -self.limit)[-self.limit]]
            size = first[at + 1] - first[at]
            own = np.repeat(first[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            score = np.r_[self.score[j], np.repeat(col[at], size)]
            ids = np.r_[self.id[j], members[own]]
            order = np.lexsort((ids, -score))[:self.limit]
            self.score[j], self.id[j] = score[order], ids[order]
            if len(order) == self.limit:
                self.floor[j] = score[order[-1]]


def _scored(weight: np.ndarray, first: np.ndarray, items: np.ndarray, item_ids: list, limit: int):
    """Best documents of one task per item; term t is held by ``items[first[t]:first[t + 1]]``."""
    n_items, holders = len(item_ids), np.diff(first)

    def run(batches):
        best = _Best(n_items, limit)
        for batch in batches:
            pairs, size = _pairs(batch.column("bag"))
            term, tf = pairs["term"].astype(np.int64), pairs["tf"].astype(np.int64)
            m = np.repeat(batch.column("m").to_numpy(), size)
            gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            ends = np.r_[0, np.cumsum(size)]
            work = np.r_[0, np.cumsum(holders[term])][ends] + n_items * np.arange(len(ends))
            ids = batch.column("ids")
            bounds, flat = ids.offsets.to_numpy().astype(np.int64), ids.values.to_numpy(zero_copy_only=False)
            i = 0
            while i < len(size):
                j = max(i + 1, int(np.searchsorted(work, work[i] + CELLS, side="right")) - 1)
                a, b = ends[i], ends[j]
                t, n = term[a:b], holders[term[a:b]]
                to = items[np.repeat(first[t] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                cell = np.repeat(np.repeat(np.arange(j - i), size[i:j]), n) * n_items + to
                add = np.repeat(gain[a:b], n)
                # doubles add whole numbers below 2**53 exactly: high and low parts are summed apart
                high, low = (np.bincount(cell, weights=x, minlength=(j - i) * n_items).astype(np.int64)
                             for x in (add >> 20, add & 0xFFFFF))
                best.add(((high << 20) + low).reshape(j - i, n_items), bounds[i:j + 1], flat)
                i = j
        count = [len(s) for s in best.score]
        item = np.repeat(np.arange(n_items, dtype=np.int32), count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(item_ids, pa.int64()).take(pa.array(item)),
             pa.array(np.concatenate([np.zeros(0, np.int64), *best.id])),
             pa.array(np.concatenate([np.zeros(0, np.int64), *best.score]))], ["item", "item_id", "id", "score"])
    return run


def _search(docs: DataFrame, items: list, limit: int) -> DataFrame:
    """Ranks for one block of items: rows of id and distinct terms."""
    spark = docs.sparkSession
    item = np.repeat(np.arange(len(items)), [len(r["terms"]) for r in items])
    held = pa.array([t for r in items for t in r["terms"]], pa.large_string()).dictionary_encode()
    vocabulary, code = held.dictionary, held.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    first = np.searchsorted(code[order], np.arange(len(vocabulary) + 1))

    path = scratch_path(spark, "term-bags")
    docs.mapInArrow(_bags(vocabulary), BAGS).write.option("compression", "zstd").parquet(path)
    bags = spark.read.schema(BAGS).parquet(path)
    total = bags.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"], total["terms"] or 1
    df = np.zeros(len(vocabulary), np.int64)
    for r in (bags.select("bag").mapInArrow(_frequencies(len(vocabulary)), "term int, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect()):     # one row per term of the block
        df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)

    m = F.expr(f"cast(50 + (cast(50 * n as decimal(28, 0)) * {n_docs}) div {n_terms} as bigint)")
    key = ["class", "m", "bag"]
    copies = Window.partitionBy(*key).orderBy("id")
    classes = (bags.where("id is not null and length(bag) > 0").select("id", m.alias("m"), "bag")
               .withColumn("class", F.xxhash64("bag", "m"))
               .withColumn("place", F.row_number().over(copies)).where(F.col("place") <= limit)
               .groupBy(*key).agg(F.collect_list("id").alias("ids")).select("m", "bag", "ids"))
    found = classes.mapInArrow(_scored(weight, first, item[order], [r["item_id"] for r in items], limit), FOUND)
    ranked = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), "id"))
    return (found.withColumn("rank", ranked).where(F.col("rank") <= limit)
            .select("item_id", "rank", F.col("id").alias("doc_id"), "score"))


def rank_documents(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", limit: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): every item's ``limit`` documents of highest score above 0.

    Terms are maximal runs of letters and digits of ASCII and of all characters beyond it; only A-Z are lower-cased.
    A term's weight is ``floor(1000 ln((2 N + 2) / (2 df + 1)))``; a document with n terms has
    ``m = 50 + (50 n N) div L``; its score sums ``weight * ((10**9 tf) div (1000 tf + 20 m))`` over
    the item's distinct terms.  Equal scores go by ascending id.

    NULL and empty texts have no terms: such documents count nowhere, such items return nothing.  A document
    without id counts in the statistics and is not returned.  Repeated rows of documents are documents of their own; repeated
    rows of an item (id and text) are one item, one id with two texts is two.  An empty table on either side gives an
    empty result.  Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    lower = F.translate(F.col(item_text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    asked = (items.select(F.col(item_col).cast("long").alias("item_id"),
                          F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("terms"))
             .where(F.size("terms") > 0).distinct())
    blocks = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // ITEM_TERMS))
    block = F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks))
    path, found = scratch_path(spark, "term-ranks"), None
    for b in range(blocks):
        rows = asked.where(block == b).orderBy("item_id", "terms").collect()
        if rows:
            found = _search(docs, rows, limit)
            if blocks > 1:
                found.write.mode("append").parquet(path)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return spark.read.schema(found.schema).parquet(path) if blocks > 1 else found
