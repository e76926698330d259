"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact sorted-array intersection.

Two documents link when the Jaccard similarity of their sets of distinct ``k``-word
shingles is at least ``num/den``.  The join is exact over all documents (up to collisions
of 64-bit hashes) and returns the connected components of the links:

1. Equal sets form a class; from here on only classes are compared.
2. With shingles in hash order, linked sets share several of their first shingles (the
   prefix lemma below).  A distributed count of prefix shingles that occur in more than
   one class leaves the few *active* classes that can have a partner at all.
3. Seed links: in each bucket of active classes with an equal min-hash and similar size, a
   spanning forest of the nearest pairs by bitmap is verified (at most one pair per member,
   never all pairs).  This gathers large groups of near copies into components at once.
4. Exact completion: a tile is (prefix shingle, size band).  Every linked pair shares a
   tile.  Tiles whose members are one component already can be skipped, as can copies of
   the same tile.  The others are cut into blocks of bounded size; inside a pair of
   blocks the XOR of parity bitmaps bounds the symmetric difference from below, hence
   the overlap from above, and only surviving pairs of different components are verified by
   intersecting the sorted shingle arrays.

Prefix lemma: a linked pair has overlap o >= need(n) = ceil(num * n / den) for either size
n.  Its c smallest common shingles therefore lie among the first n - need(n) + c
shingles of both sets.  With c(n) = 1 + n // 10 on each side, a set of size n has at least
c(need(n)) shared shingles in its prefix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import caches
from . import grams as G
from . import words as W
from .graph import components, saved

SEEDS = 4                 # min-hash buckets per class in the seed step
BITS = 1024               # smallest parity bitmap; larger sets have as many bits as shingles
BLOCK = 1024              # members of one side of a tile's block pair
BUCKET_SHINGLES = 4_000_000   # prefix shingles that one counting task holds, on average
BROADCAST_CLASSES = 1_000_000  # active classes (24 bytes each) up to which they are broadcast


def need(n, num: int, den: int):
    """Smallest overlap with any partner."""
    return -(-n * num // den)


def slack(n):
    """Extra prefix shingles; also the number of shared ones that the lemma guarantees."""
    return 1 + n // 10


def _class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) or 1


def _rows(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row number, shingle set) of a batch's ``text`` column, in bounded chunks."""
    raw, offsets = W.text_buffer(batch.column("text"))
    for i, j in W.row_chunks(offsets):
        part = W.shingle_sets(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
        yield from enumerate(part, start=i)


def _members(k: int):
    @caches.task("jaccard_join")
    def run(batches):
        for batch in batches:
            n, cls = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.uint64)
            for row, s in _rows(batch, k):
                if len(s):
                    n[row], cls[row] = len(s), _class_of(s)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("th"), pa.array(n), pa.array(cls.view(np.int64), mask=n == 0)],
                ["id", "th", "n", "cls"])
    return run


def _prefix_chunks(k: int, num: int, den: int, buckets: int):
    """Per Arrow batch and bucket: prefix shingles with their class.

    Pre-aggregated: a shingle that several classes of the batch share is sent once, marked 0, and
    those classes get their count here, so a shingle of a third of all documents
    costs one entry per batch.
    """
    @caches.task("jaccard_join")
    def run(batches):
        for batch in batches:
            seen, parts, owners = set(), [], []
            for _, s in _rows(batch, k):
                cls = _class_of(s) if len(s) else 0
                if cls and cls not in seen:
                    seen.add(cls)
                    n = len(s)
                    parts.append(s[:min(n, n - need(n, num, den) + slack(n))])
                    owners.append(cls)
            if not parts:
                continue
            token = np.concatenate(parts)
            owner = np.repeat(np.array(owners, dtype=np.uint64), [len(p) for p in parts])
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            first = np.r_[True, token[1:] != token[:-1]]
            size = np.diff(np.r_[np.flatnonzero(first), len(token)])
            shared = np.repeat(size > 1, size)
            cls, count = np.unique(owner[shared], return_counts=True)
            owner[shared] = 0
            keep = first | ~shared
            token, owner = token[keep], owner[keep]
            at = (token % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(at, kind="stable")
            token, owner = token[order], owner[order]
            cut = np.searchsorted(at[order], np.arange(buckets + 1))
            home = (cls % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(home, kind="stable")
            cls, count = cls[order], count[order].astype(np.int32)
            cut2 = np.searchsorted(home[order], np.arange(buckets + 1))
            cell = lambda x, c: pa.array([x[c[i]:c[i + 1]].tobytes() for i in range(buckets)], pa.binary())
            yield G.filled(pa.RecordBatch.from_arrays(
                [pa.array(np.arange(buckets, dtype=np.int32)), cell(token, cut), cell(owner, cut),
                 cell(cls, cut2), cell(count, cut2)], ["bucket", "token", "owner", "cls", "count"]), ["token", "cls"])
    return run


def _shared_counts(table: pa.Table) -> pa.Table:
    """Shared prefix shingles per class inside one bucket."""
    def joined(name, dtype):
        return np.frombuffer(b"".join(table[name].to_pylist()), dtype=dtype)
    token, owner = joined("token", np.uint64), joined("owner", np.uint64)
    cls, count = joined("cls", np.uint64), joined("count", np.int32).astype(np.int64)
    if len(token):
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        fresh = np.r_[True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])]
        token, owner = token[fresh], owner[fresh]
        start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        size = np.diff(np.r_[start, len(token)])
        hit = owner[np.repeat(size > 1, size)]
        found, times = np.unique(hit[hit != 0], return_counts=True)
        cls, count = np.r_[cls, found], np.r_[count, times]
    cls, at = np.unique(cls, return_inverse=True)
    total = np.bincount(at, weights=count, minlength=len(cls)).astype(np.int64) if len(cls) else count
    return pa.table({"cls": pa.array(cls.view(np.int64)), "shared": pa.array(total)})


def _bitmap(shingles: np.ndarray) -> bytes:
    """Bit i = parity of the shingles that hash to i, so XOR of two bitmaps has at most as
    many ones as the symmetric difference has members.  The width is a power of two not
    below the set's size: a fixed width would be full, and bound nothing, for long texts."""
    width = max(BITS, 1 << (len(shingles) - 1).bit_length())
    return np.packbits(np.bincount((shingles >> np.uint64(7)) % np.uint64(width), minlength=width) & 1).tobytes()


def _folded(bitmap: bytes, width: int) -> np.ndarray:
    """The bitmap at a smaller power-of-two width: parities of bits that fall together."""
    return np.bitwise_xor.reduce(np.frombuffer(bitmap, np.uint8).reshape(-1, width // 8), axis=0)


def _active_sets(k: int):
    """Set, bitmap and seed keys of the active classes' representatives."""
    salts = np.uint64(0x9E3779B97F4A7C15) * np.arange(1, 2 * SEEDS, 2, dtype=np.uint64)

    @caches.task("jaccard_join")
    def run(batches):
        for batch in batches:
            cls, rows = batch.column("cls").to_numpy(zero_copy_only=False), []
            for row, s in _rows(batch, k):
                if len(s) and np.uint64(_class_of(s)).astype(np.int64) == cls[row]:
                    # size classes whose borders shift from seed to seed
                    size = (math.log(len(s)) / math.log(1.25) + 1 + np.arange(SEEDS) / SEEDS).astype(np.uint64)
                    least = np.array([W.mix(s * salt).min() for salt in salts])
                    keys = W.mix(least * np.uint64(31) + size + salts).view(np.int64)
                    rows.append((int(cls[row]), len(s), s.tobytes(), _bitmap(s), keys.tolist()))
            if rows:
                c, n, sets, bits, keys = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()), pa.array(n, pa.int64()), pa.array(sets, pa.binary()),
                     pa.array(bits, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["cls", "n", "set", "bits", "keys"])
    return run


def _linked(num: int, den: int):
    """Keep the pairs whose sorted arrays overlap enough."""
    @caches.task("jaccard_join")
    def run(batches):
        for batch in batches:
            left, right = batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()
            keep = []
            for x, y in zip(left, right):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if num * max(len(a), len(b)) > den * min(len(a), len(b)):
                    keep.append(False)
                    continue
                at = np.searchsorted(b, a)
                at[at == len(b)] = 0
                both = int(np.count_nonzero(b[at] == a))
                keep.append(den * both >= num * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    a = sets.select(F.col("cls").alias("a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("cls").alias("b"), F.col("set").alias("set_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b").mapInArrow(
        _linked(num, den), "a long, b long")


def _postings(num: int, den: int):
    """(tile, cls, comp): each prefix shingle in the set's size band and the next one up."""
    ratio = math.log(den / num)

    @caches.task("jaccard_join")
    def run(batches):
        for batch in batches:
            tiles, counts = [], []
            for raw in batch.column("set").to_pylist():
                s = np.frombuffer(raw, np.uint64)
                n = len(s)
                head = s[:n - need(n, num, den) + 1]
                # the margin keeps a pair of exactly the limit ratio within one band step
                band = int(math.log(n) / (ratio * (1 + 1e-9)))
                for x in (band, band + 1):
                    tiles.append(W.mix(head + np.uint64(0xA24BAED4963EE407 * (x + 1) & (1 << 64) - 1)))
                counts.append(2 * len(head))
            if tiles:
                at = np.repeat(np.arange(len(counts)), counts)
                own = batch.select(["cls", "comp"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tiles).view(np.int64)), own.column(0), own.column(1)],
                    ["tile", "cls", "comp"])
    return run


class _Block:
    """Members of one group with their bitmaps folded to one width."""

    def __init__(self, table: pa.Table, num: int, den: int):
        self.cls, self.n = table["cls"].to_numpy(), table["n"].to_numpy()
        maps = table["bits"].to_pylist()
        self.width = 8 * min(map(len, maps))
        self.packed = np.stack([_folded(m, self.width) for m in maps])
        self.num, self.den = num, den

    def pairs(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(left rows, right rows, differing bits over joint size) of the pairs that sizes and bitmaps allow."""
        num, den = self.num, self.den
        step = max(1, min(256, (1 << 22) // self.width))
        for s in range(0, len(left), step):
            x = left[s:s + step]
            f = np.unpackbits(self.packed[x], axis=1).astype(np.float32)
            for t in range(0, len(right), step):
                y = right[t:t + step]
                g = np.unpackbits(self.packed[y], axis=1).astype(np.float32)
                differ = f.sum(axis=1)[:, None] + g.sum(axis=1)[None] - 2 * (f @ g.T)
                a, b = self.n[x][:, None], self.n[y][None]
                # overlap <= (a + b - differ) / 2, and a link needs overlap >= num / (num + den) * (a + b)
                ok = (num + den) * (a + b - differ) >= 2 * num * (a + b)
                ok &= num * np.maximum(a, b) <= den * np.minimum(a, b)
                p, q = np.nonzero(ok)
                yield x[p], y[q], differ[p, q] / (a + b)[p, q]


def _pair_table(a: np.ndarray, b: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})


def _seed_pairs(num: int, den: int):
    """A spanning forest of one bucket's allowed pairs, nearest pairs first: at most one pair per member."""
    def run(table: pa.Table) -> pa.Table:
        block = _Block(table, num, den)
        every = np.arange(len(block.cls))
        x, y, far = (np.concatenate(c) for c in zip(*block.pairs(every, every)))
        once = x < y
        x, y, far = x[once], y[once], far[once]
        root, kept = every.tolist(), []

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for k in np.argsort(far, kind="stable").tolist():
            i, j = find(int(x[k])), find(int(y[k]))
            if i != j:
                root[i] = j
                kept.append(k)
                if len(kept) == len(every) - 1:
                    break
        return _pair_table(block.cls[x[kept]], block.cls[y[kept]])
    return run


def _tile_pairs(num: int, den: int):
    """Pairs of one block pair that sizes and bitmaps allow, between different components."""
    def run(table: pa.Table) -> pa.Table:
        block = _Block(table, num, den)
        comp, side = table["comp"].to_numpy(), table["block"].to_numpy()
        lo = table["i"][0].as_py()
        left = np.flatnonzero(side == lo)
        same = table["j"][0].as_py() == lo
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x, y, _ in block.pairs(left, left if same else np.flatnonzero(side != lo)):
            new = (comp[x] != comp[y]) & ((x < y) | (not same))
            out_a.append(block.cls[x[new]])
            out_b.append(block.cls[y[new]])
        return _pair_table(np.concatenate(out_a), np.concatenate(out_b))
    return run


def _components(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> DataFrame:
    """(id, th, n_shingles, component_id), one row per input row; ``th`` is the text's hash."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed_text = base.withColumn("th", F.xxhash64("text"))
    members = saved(keyed_text.mapInArrow(_members(k), "id long, th long, n long, cls long"))
    classes = saved(members.where("cls is not null").groupBy("cls").agg(
        F.min("id").alias("min_id"), F.min(F.struct("id", "th")).alias("rep"),
        F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")))
    totals = classes.agg(F.sum("n").alias("shingles")).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * partitions, math.ceil((totals["shingles"] or 0) / BUCKET_SHINGLES))

    shared = (base.select("text").mapInArrow(_prefix_chunks(k, num, den, buckets),
                                             "bucket int, token binary, owner binary, cls binary, count binary")
              .groupBy("bucket").applyInArrow(_shared_counts, "cls long, shared long")
              .groupBy("cls").agg(F.sum("shared").alias("shared")))
    floor_need = F.floor((F.col("n") * num + (den - 1)) / den)
    active = saved(shared.join(classes, "cls").where(F.col("shared") >= 1 + F.floor(floor_need / 10))
                   .select("cls", F.col("rep.id").alias("rep_id"), F.col("rep.th").alias("rep_th")))
    few = active.count() <= BROADCAST_CLASSES
    chosen = keyed_text.join(F.broadcast(active) if few else active,
                             (F.col("th") == F.col("rep_th")) & F.col("id").eqNullSafe(F.col("rep_id")))
    sets = saved(chosen.select("cls", "text").mapInArrow(
        _active_sets(k), "cls long, n long, set binary, bits binary, keys array<long>"))
    if sets.select("cls").groupBy("cls").count().where("count > 1").limit(1).count():
        sets = saved(sets.dropDuplicates(["cls"]))   # the representative's row was repeated

    keyed = sets.select("cls", F.explode("keys").alias("key"))
    buckets = (keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("cuts"),
                                        F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"))
    seeds = (keyed.join(buckets, "key").join(sets.select("cls", "n", "bits"), "cls")
             .withColumn("cut", F.pmod(F.xxhash64("cls"), "cuts")).groupBy("key", "cut")
             .applyInArrow(_seed_pairs(num, den), "a long, b long").distinct())
    first = saved(_verify(seeds, sets, num, den))
    labels = components(first)

    placed = (sets.join(labels, F.col("cls") == F.col("node"), "left")
              .withColumn("comp", F.coalesce("label", "cls")).select("cls", "comp", "n", "set", "bits"))
    postings = placed.select("cls", "comp", "set").mapInArrow(_postings(num, den), "tile long, cls long, comp long")
    tiles = (postings.groupBy("tile").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("c"),
        F.expr("bit_xor(xxhash64(cls))").alias("x"), F.expr("sum(pmod(xxhash64(cls, 7), 2147483647))").alias("s"))
        .where("lo < hi").groupBy("c", "x", "s").agg(F.min("tile").alias("tile")))
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    spread = (postings.select("tile", "cls").join(tiles.select("tile", "c"), "tile")
              .withColumn("block", F.pmod(F.xxhash64("cls", F.lit(3)), blocks).cast("int"))
              .join(placed.select("cls", "comp", "n", "bits"), "cls")
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
              .select("tile", "cls", "comp", "n", "bits", "block",
                      F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    candidates = (spread.groupBy("tile", "i", "j")
                  .applyInArrow(_tile_pairs(num, den), "a long, b long").where("a <> b").distinct())
    second = _verify(candidates, sets, num, den)
    labels = components(first.unionByName(second))

    joined = classes.join(labels, F.col("cls") == F.col("node"), "left")
    least = (joined.where("label is not null").groupBy("label").agg(F.min("min_id").alias("component")))
    named = saved(joined.where("label is not null or copies > 1").join(least, "label", "left")
                  .select("cls", F.coalesce("component", "min_id").alias("component")))
    return (members.join(named, "cls", "left")
            .select("id", "th", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       num: int = 4, den: int = 5) -> DataFrame:
    """(``id_col``, ``n_shingles``, ``component_id``), one row per input row.

    ``component_id`` is the smallest id reachable over links, itself included.
    NULL or blank text: 0 shingles, linked with nothing, its own component.  Repeated
    rows are linked like copies.  A NULL id takes part but never names a component; it
    gets its component's smallest id, or NULL if there is none.  Other columns,
    whatever their names, are ignored.  An empty table gives an empty result.
    """
    found = _components(docs, id_col, text_col, k, num, den)
    return found.select(F.col("id").alias(id_col), "n_shingles", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
             num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component: that of smallest id.

    Repeated rows of the kept document (same id and text) are reduced to one.  Documents without words
    all stay, and so do rows with a NULL id, as nothing names them.
    """
    found = saved(_components(docs, id_col, text_col, k, num, den).where("id is not null and n_shingles > 0")
                  .select(F.col("id").alias("drop_id"), F.col("th").alias("drop_th"),
                          (F.col("id") != F.col("component_id")).alias("dropped")))
    th = F.xxhash64(docs[text_col].cast("string"))

    def minus(rows: DataFrame, how: str) -> DataFrame:
        few = rows.count() <= BROADCAST_CLASSES
        same = (docs[id_col].cast("long") == rows["drop_id"]) & (th == rows["drop_th"])    # whatever else ``docs`` holds
        return docs.join(F.broadcast(rows) if few else rows, same, how)

    repeated = saved(found.where(~F.col("dropped")).groupBy("drop_id", "drop_th").count().where("count > 1")
                     .select("drop_id", "drop_th"))
    gone = found.where("dropped").select("drop_id", "drop_th").distinct()
    if repeated.isEmpty():
        return minus(gone, "left_anti")
    once = minus(repeated, "left_semi").dropDuplicates([id_col, text_col])
    return minus(gone.unionByName(repeated), "left_anti").unionByName(once)
