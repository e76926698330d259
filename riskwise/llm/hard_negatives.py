"""Hard-negative mining with exact integer inner products, by the method of the Four Russians.

An anchor's components are taken in groups of eight; for every group a table holds the sums of all
256 subsets of its components.  A candidate's integer components are stored as bit planes (two's
complement), eight dimensions to a byte, so one table lookup per plane and group replaces eight
multiplications: planes are added from the highest down, doubling in between.  The result is the whole
exact inner product, not an estimate.

Anchors (a stated set: one row in ``anchor_every``) and candidates are dealt into blocks by the hash of
their id, and every pair of blocks is one task.  A first pass scores rows of the anchor's own label and
finds its positives, a second scores all others, so together they score each row once per anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskwise.session import ship

from .graph import saved

SCALE = 256               # components become floor(SCALE * x)
ANCHOR_BLOCK = 2048       # anchors of one task, on average
ROW_BLOCK = 8192          # candidates of one task, on average
TABLE_BYTES = 8 << 20     # subset-sum tables held at a time
SCORES = 1 << 21          # scores held at a time

SIDE = "block int, chunk int, vec_id long, label int, planes binary"
POSITIVES = "anchor_id long, positive_id long, positive_score long"
NEGATIVES = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _planes(bits: int, groups: int):
    """Bit planes of the scaled components, eight dimensions to a byte; shorter vectors end in zeros."""
    def run(batches):
        for batch in batches:
            column = batch.column("vec").cast(pa.list_(pa.float64()))
            length = np.diff(column.offsets.to_numpy())
            scaled = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False)).astype(np.int64)
            x = np.zeros((len(column), 8 * groups), np.int64)
            row = np.repeat(np.arange(len(column)), length)
            x[row, np.arange(len(scaled)) - np.repeat(np.cumsum(length) - length, length)] = scaled
            packed = np.stack([np.packbits(((x >> k) & 1).astype(np.uint8), axis=1, bitorder="little")
                               for k in range(bits)], axis=1)
            planes = pa.array([p.tobytes() for p in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), planes],
                                             ["vec_id", "label", "planes"])
    return run


def _unpacked(cells: pa.ChunkedArray, bits: int, groups: int) -> np.ndarray:
    """uint8 array (row, plane, group)."""
    return np.frombuffer(b"".join(cells.to_pylist()), np.uint8).reshape(-1, bits, groups)


def _vectors(planes: np.ndarray) -> np.ndarray:
    """The integer components that the planes stand for."""
    bits = planes.shape[1]
    x = np.zeros((len(planes), 8 * planes.shape[2]), np.int64)
    for k in range(bits):
        one = np.unpackbits(planes[:, k], axis=1, bitorder="little").astype(np.int64)
        x += one * (-(1 << k) if k == bits - 1 else 1 << k)
    return x


def subset_sums(vectors: np.ndarray) -> np.ndarray:
    """Table (group, subset, vector): sums over every subset of each eight components."""
    n, dims = vectors.shape
    table = np.zeros((dims // 8, 256, n), np.int64)
    for i in range(8):    # subsets that hold component i = those of the components before it, plus component i
        table[:, 1 << i:2 << i] = table[:, :1 << i] + vectors.T[i::8][:, None]
    return table


def scores(table: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products (candidate, anchor) by lookups: highest plane first, doubling before each next one."""
    bits, groups = planes.shape[1:]
    total = np.zeros((len(planes), table.shape[2]), np.int64)
    for k in reversed(range(bits)):
        if k < bits - 1:
            total += total
        for g in range(groups):
            found = table[g].take(planes[:, k, g], axis=0)
            if k == bits - 1:
                total -= found          # the sign plane
            else:
                total += found
    return total


def _blocks(anchors: np.ndarray, rows: int, groups: int):
    """Ranges of anchors whose tables and scores fit the bounds."""
    step = max(1, min(TABLE_BYTES // (2048 * max(groups, 1)), SCORES // max(rows, 1)))
    return ((anchors[i:i + step]) for i in range(0, len(anchors), step))


def _scored(left: pa.Table, right: pa.Table, same: bool, bits: int, groups: int):
    """(anchors, candidates, scores) by label: candidates of the anchors' label or of all others, ids ascending."""
    right = right.sort_by("vec_id")
    label, ids = right["label"].to_numpy(), right["vec_id"].to_numpy()
    planes, own = _unpacked(right["planes"], bits, groups), left["label"].to_numpy()
    vectors = _vectors(_unpacked(left["planes"], bits, groups))
    for x in np.unique(own):
        at = np.flatnonzero((label == x) == same)
        if len(at):
            mine = planes[at]
            for a in _blocks(np.flatnonzero(own == x), len(at), groups):
                yield a, ids[at], scores(subset_sums(vectors[a]), mine)


def _first(score: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` highest scores, ties by position."""
    if len(score) > n:
        at = np.flatnonzero(score >= np.partition(score, -n)[-n])
    else:
        at = np.arange(len(score))
    return at[np.argsort(-score[at], kind="stable")[:n]]


def _positives(bits: int, groups: int, n: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        anchor = left["vec_id"].to_numpy()
        for a, ids, s in _scored(left, right, True, bits, groups):
            for j, i in enumerate(a):
                other = np.flatnonzero(ids != anchor[i])
                best = other[_first(s[other, j], n)]
                for col, x in zip(out, (np.full(len(best), anchor[i]), ids[best], s[best, j])):
                    col.append(x)
        return _table(out, ["anchor_id", "positive_id", "positive_score"])
    return run


def _negatives(bits: int, groups: int, n: int, low: int, high: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        anchor, positives = left["vec_id"].to_numpy(), left["positives"].to_pylist()
        for a, ids, s in _scored(left, right, False, bits, groups):
            for j, i in enumerate(a):
                col = s[:, j]
                for p in positives[i]:
                    ps = p["positive_score"]
                    least, most = -(-low * ps // 100), high * ps // 100
                    at = np.flatnonzero((col >= least) & (col <= most))
                    best = at[_first(col[at], n)]
                    m = len(best)
                    for c, x in zip(out, (np.full(m, anchor[i]), np.full(m, p["positive_id"]), np.full(m, ps),
                                          ids[best], col[best])):
                        c.append(x)
        return _table(out, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    return run


def _table(columns: list[list[np.ndarray]], names: list[str]) -> pa.Table:
    return pa.table({n: np.concatenate(c) if c else np.zeros(0, np.int64) for n, c in zip(names, columns)})


def _best(df: DataFrame, keys: list[str], score: str, other: str, n: int) -> DataFrame:
    """The ``n`` best rows of every key with their rank; Spark limits each task's rows before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(other))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine_hard_negatives(rows: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                        anchor_every: int = 100, n_positives: int = 5, n_negatives: int = 5,
                        low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``anchor_every``.  An anchor's positives are the
    ``n_positives`` other rows of its label with the highest inner product of ``floor(256 * x)``; for each,
    the ``n_negatives`` highest rows of other labels with ``low * positive <= 100 * negative <= high * positive``
    are returned, ties by smaller id.

    Rows with a NULL id, label, vector or component, or a component that is not finite, take no part.
    Vectors of other lengths count as padded with zeros; the empty vector scores 0.  Of rows with one id the
    one with the smallest label (then planes) takes part.  An empty table, or one without anchors, gives no rows.
    Components so large that a score might leave 64 bits are an error that says so.  Other columns are ignored.
    """
    ship(rows.sparkSession)
    vec = F.col("vec")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("int").alias("label"),
                         F.col(vec_col).cast("array<double>").alias("vec"))
             .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vec.isNotNull()).where(~bad))
    size = valid.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("vec_id") % anchor_every == 0).alias("anchors"),
                     F.max(F.size("vec")).alias("dims"),
                     F.max(F.array_max(F.transform("vec", lambda x: F.abs(F.floor(x * SCALE).cast("double"))))).alias("most"),
                     F.max(F.array_max(F.transform("vec", lambda x: F.abs(x)))).alias("raw")).first()
    dims, most = size["dims"] or 0, int(max(size["most"] or 0, (size["raw"] or 0) * SCALE)) + 1
    if 100 * max(dims, 1) * most * most >= 1 << 62:
        raise ValueError(f"components up to {size['raw']} in {dims} dimensions: scores may exceed 64-bit integers")
    bits, groups = most.bit_length() + 1, max(1, -(-dims // 8))
    a, c = max(1, -(-size["anchors"] // ANCHOR_BLOCK)), max(1, -(-size["n"] // ROW_BLOCK))

    packed = saved(valid.mapInArrow(_planes(bits, groups), "vec_id long, label int, planes binary")
                   .groupBy("vec_id").agg(F.min(F.struct("label", "planes")).alias("r")).select("vec_id", "r.*"))
    home = F.xxhash64("vec_id")
    block, chunk = F.pmod(home, F.lit(a)).cast("int"), F.pmod(F.shiftright(home, 20), F.lit(c)).cast("int")
    tiles = min(a * c, 1 << 16)

    def dealt(df: DataFrame, block, chunk):
        """One copy per tile; the number of tasks is fixed, as the tiles' work is in their scores, not their bytes."""
        return df.withColumn("block", block).withColumn("chunk", chunk).repartition(tiles, "block", "chunk")

    candidates = dealt(packed, F.explode(F.sequence(F.lit(0), F.lit(a - 1))), chunk)
    anchors = packed.where(F.col("vec_id") % anchor_every == 0).select(*[F.col(x).alias(x) for x in packed.columns])

    def against(left: DataFrame, run, schema: str) -> DataFrame:
        left = dealt(left, block, F.explode(F.sequence(F.lit(0), F.lit(c - 1))))
        return left.groupBy("block", "chunk").cogroup(candidates.groupBy("block", "chunk")).applyInArrow(run, schema)

    found = _best(against(anchors, _positives(bits, groups, n_positives), POSITIVES),
                  ["anchor_id"], "positive_score", "positive_id", n_positives)
    positives = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    best = _best(against(anchors.join(positives, "vec_id"), _negatives(bits, groups, n_negatives, low, high), NEGATIVES),
                 ["anchor_id", "positive_id"], "negative_score", "negative_id", n_negatives)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
