"""Reproducible splits.

``randomSplit`` depends on the partitioning of its input, so every split here is
a function of the row's key: the first 32 bits of ``md5(key)``.  The same rows
land on the same side on any cluster size and in any engine.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwise.operators.quantiles import kth_values
from riskwise.session import shared_dir


def key_hash(key_cols: Sequence[str], digits: int = 8) -> Column:
    """Unsigned hash of the key: the first ``digits`` hex digits of md5 (8 -> 32
    bits, 13 -> 52 bits, still exact as a double) as bigint; the same value in any engine."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in key_cols])
    return F.conv(F.substring(F.md5(key), 1, digits), 16, 10).cast("bigint")


def hash_split(df: DataFrame, key_cols: Sequence[str], test_pct: int = 20, col: str = "split") -> DataFrame:
    """``test`` when ``hash % 100 >= 100 - test_pct``, else ``train``.

    Rows sharing a key (e.g. the lines of one order) always stay together, so no
    group leaks across the split.
    """
    b = key_hash(key_cols) % 100
    return df.withColumn(col, F.when(b < 100 - test_pct, F.lit("train")).otherwise(F.lit("test")))


def fold_assign(df: DataFrame, key_cols: Sequence[str], k: int = 3, col: str = "fold") -> DataFrame:
    """Fold id in [0, k) from the key hash; usable as ``CrossValidator.foldCol``."""
    return df.withColumn(col, (key_hash(key_cols) % k).cast("int"))


def _kth_per_class(df: DataFrame, label: str, col: str, ranks: dict) -> tuple:
    """Exact ``ranks[v]``-th smallest ``col`` within each class ``v`` (one pivoted
    column per class, distributed histogram narrowing), and per class the number
    of rows strictly below it."""
    labels = [v for v, k in ranks.items() if k >= 1]
    if not labels:
        return {}, {}
    piv = df.select(*[F.when(F.col(label) == v, F.col(col)).alias(f"__c{i}") for i, v in enumerate(labels)])
    under: dict = {}
    kth = kth_values(piv, [f"__c{i}" for i in range(len(labels))],
                     {f"__c{i}": [ranks[v]] for i, v in enumerate(labels)}, below=under)
    return ({v: kth.get((f"__c{i}", ranks[v])) for i, v in enumerate(labels)},
            {v: under.get((f"__c{i}", ranks[v]), 0) for i, v in enumerate(labels)})


def _per_class(label: str, values: dict, cast: str) -> Column:
    e = F.lit(None).cast(cast)
    for v, t in values.items():
        if t is not None:
            e = F.when(F.col(label) == v, F.lit(t).cast(cast)).otherwise(e)
    return e


PREFIX_BITS = 12          # of the key hash: classes x 4,096 counts are collected
RANKED_ROWS = 1_000_000   # rows of one class in its cut prefix up to which they are ranked in one window


def _cut_prefixes(base: DataFrame, label: str, prefix: Column, test_frac: float) -> dict:
    """Per class: (prefix in which the test side ends, test rows in it, rows in it), from one histogram."""
    counts: dict = {}
    for v, p, n in base.groupBy(label, prefix.alias("__p")).count().collect():
        if v is not None:
            counts.setdefault(v, []).append((p, n))
    cuts = {}
    for v, found in counts.items():
        room = math.ceil(test_frac * sum(n for _, n in found) - 1e-9)
        for p, n in sorted(found):
            if 0 < room <= n:
                cuts[v] = (p, room, n)
            room -= n
    return cuts


def stratified_split(df: DataFrame, label: str, key_cols: Sequence[str], tie_cols: Sequence[str],
                     test_frac: float = 0.2, col: str = "split", ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """Exact stratified split.

    Per label value, the ``ceil(test_frac * n_label)`` rows first in the order
    (key hash, row hash) form the test side - the same cut as
    ``row_number() OVER (PARTITION BY label ORDER BY key_hash, row_hash)``, where
    the row hash is a 52-bit md5 of the tie columns (exact as a double) - without ever ranking a whole
    class, a whole key or a whole group of copies in one task:

    1. a histogram of the first 12 bits of the key hash per class says in which prefix a class is cut;
    2. the rows of the cut prefixes, about 1/4,096 of the table, are stored; all others are decided by their prefix;
    3. stored rows are ranked in one window per class, if the histogram says that there are at most ``ranked_rows``.
       A key with a large part of the table makes more: then the cuts on key hash and row hash are exact k-th values
       (see ``quantiles``), and rows still tied, which are copies, so that it makes no difference
       which are taken, are taken by per-partition quotas.

    The table is read twice, and once more for the output.
    """
    h, h2 = "__h", "__h2"
    base = df.withColumn(h, key_hash(key_cols))
    prefix = F.shiftright(F.col(h), 32 - PREFIX_BITS)
    cuts = _cut_prefixes(base, label, prefix, test_frac)
    b0 = base.withColumn("__t0", _per_class(label, {v: c[0] for v, c in cuts.items()}, "bigint")).withColumn("__p", prefix)
    outside = F.col("__t0").isNull() | (F.col("__p") != F.col("__t0"))
    rest0 = b0.where(outside).withColumn(col, F.when(F.col("__p") < F.col("__t0"), "test").otherwise("train"))
    # read by every later pass: stored once in the shared folder (a reliable checkpoint, so its
    # partitions are also fixed for the quotas below)
    shared_dir(df.sparkSession)
    near = (b0.where(~outside).drop("__t0", "__p").withColumn(h2, key_hash(tie_cols, 13) if tie_cols else F.lit(0))
            .checkpoint(eager=True))
    rest0 = rest0.drop(h, "__t0", "__p")
    need = {v: c[1] for v, c in cuts.items()}
    if all(c[2] <= ranked_rows for c in cuts.values()):
        first = F.row_number().over(Window.partitionBy(label).orderBy(h, h2)) <= _per_class(label, need, "bigint")
        return rest0.unionByName(near.withColumn(col, F.when(first, "test").otherwise("train")).drop(h, h2))
    return rest0.unionByName(_cut_exactly(near, label, need, col))


def _cut_exactly(base: DataFrame, label: str, need: dict, col: str) -> DataFrame:
    """The rows with ``col``: per class, the ``need`` first in the order of ``__h`` and ``__h2`` are ``test``."""
    h, h2 = "__h", "__h2"
    # level 1: key hash
    thr1, below1 = _kth_per_class(base, label, h, need)
    b1 = base.withColumn("__t1", _per_class(label, thr1, "bigint"))
    room1 = {v: need[v] - below1.get(v, 0) for v in thr1}
    rest1 = (b1.where(F.col("__t1").isNull() | (F.col(h) != F.col("__t1")))
             .withColumn(col, F.when(F.col(h) < F.col("__t1"), "test").otherwise("train")))
    # the tie group is read by every later pass
    tie1 = b1.where(F.col(h) == F.col("__t1")).checkpoint(eager=True)

    # level 2: tie-column hash inside the tied key
    thr2, below2 = _kth_per_class(tie1, label, h2, room1)
    b2 = tie1.withColumn("__t2", _per_class(label, thr2, "bigint"))
    room2 = {v: room1[v] - below2.get(v, 0) for v in thr2}
    rest2 = (b2.where(F.col("__t2").isNull() | (F.col(h2) != F.col("__t2")))
             .withColumn(col, F.when(F.col(h2) < F.col("__t2"), "test").otherwise("train")))

    # level 3: copies - per-partition quotas
    tie2 = (b2.where(F.col(h2) == F.col("__t2"))
            .withColumn("__pid", F.spark_partition_id())
            .withColumn("__mid", F.monotonically_increasing_id()))
    per = sorted((r[label], r["__pid"], r["count"])
                 for r in tie2.groupBy(label, "__pid").count().collect())  # classes x partitions
    left = dict(room2)
    quota = []
    for v, pid, c in per:
        q = max(0, min(c, left.get(v, 0)))
        left[v] = left.get(v, 0) - q
        quota.append((v, pid, q))
    qschema = T.StructType([T.StructField(label, base.schema[label].dataType),
                            T.StructField("__pid", T.IntegerType()), T.StructField("__q", T.LongType())])
    qdf = base.sparkSession.createDataFrame(quota, qschema)
    w = Window.partitionBy(label, "__pid").orderBy("__mid")
    rest3 = (tie2.join(F.broadcast(qdf), [label, "__pid"], "left")  # bounded: classes x partitions
             .withColumn(col, F.when(F.row_number().over(w) <= F.coalesce(F.col("__q"), F.lit(0)), "test")
                         .otherwise("train"))
             .drop("__pid", "__mid", "__q"))
    drop = [h, h2, "__t1", "__t2"]
    return (rest1.drop(*drop).unionByName(rest2.drop(*drop)).unionByName(rest3.drop(*drop)))
