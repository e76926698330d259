"""Running totals over a global order without a single-partition window.

A window ``ORDER BY x`` with no ``PARTITION BY`` runs in one task.  Here the
order values are cut into ``buckets`` ranges of roughly equal size (edges from an
approximate quantile sketch - a bounded summary), then:

* per-(group, bucket) totals (at most groups x buckets rows) get their offsets
  from a window over that small table;
* inside each (group, bucket) a partitioned window adds the running part.

Every step is partitioned; the largest window partition is ~1/buckets of the
distinct order values of one group.  Rows that share an order value should be
pre-aggregated by the caller (one row per value), so a hot value costs one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskwise.operators.quantiles import sketch_points, task_group, valid

ROWS_PER_BUCKET = 1_000_000
MIN_BUCKETS, MAX_BUCKETS = 16, 65536


def bucket_count(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets so that one window partition holds about ``rows_per_bucket`` rows."""
    return int(min(MAX_BUCKETS, max(MIN_BUCKETS, -(-n_rows // rows_per_bucket))))


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                   group_cols: Sequence[str] = (), buckets: int | None = None,
                   previous: Sequence[str] = ()) -> DataFrame:
    """Adds ``before_<c>``: the sum of ``c`` over rows of the same group with a
    strictly smaller ``order_col`` (ties broken by nothing: pre-aggregate first).

    ``previous`` names columns whose value in the row before, by ``order_col``, is added as ``prev_<c>`` (NULL in
    a group's first row); a bucket's first row gets it from the border row of the last bucket before it that has any.

    ``buckets`` defaults to one per ~1M input rows (16 to 65,536), so the largest
    window partition stays around a million rows at any table size; the sketch, merged in
    two levels, follows the bucket count.
    """
    group_cols = list(group_cols)
    if buckets is None:
        buckets = bucket_count(df.count())
    probs = [i / buckets for i in range(1, buckets)]
    k = min(65535, max(1024, 4 * buckets))
    sketch = (df.groupBy(task_group()).agg(F.kll_sketch_agg_double(valid(order_col), k).alias("s"))
              .where(F.kll_sketch_get_n_double("s") > 0).agg(F.kll_merge_agg_double("s", k).alias("s")))
    edges = sketch.select(sketch_points("s", probs)).first()[0] or [0.0]  # no values: any edge will do
    splits = [float("-inf")] + sorted({float(e) for e in edges if e is not None}) + [float("inf")]
    src = df.withColumn("__x", F.col(order_col).cast("double"))
    b = Bucketizer(splits=splits, inputCol="__x", outputCol="__b", handleInvalid="keep").transform(src)
    before = F.struct(*previous, F.lit(True).alias("__any"))
    tot = b.groupBy(*group_cols, "__b").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols],
                                            F.max_by(before, F.col(order_col)).alias("__last"))
    wb = Window.partitionBy(*group_cols).orderBy("__b")
    up_to = wb.rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*group_cols, "__b",
                     *[F.coalesce(F.sum(f"__t_{c}").over(up_to), F.lit(0)).alias(f"__o_{c}") for c in sum_cols],
                     *([F.lag("__last").over(wb).alias("__border")] if previous else []))
    # ``off`` has at most groups x buckets rows; AQE broadcasts it when its measured
    # size is under the broadcast threshold and shuffles it otherwise.
    off = off.withColumnsRenamed({c: f"__g_{c}" for c in group_cols} | {"__b": "__ob"})
    same = F.col("__b").eqNullSafe(F.col("__ob"))  # rows with a NULL group or order value stay
    for c in group_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
    j = b.join(off, same).drop("__ob", *[f"__g_{c}" for c in group_cols])
    w = Window.partitionBy(*group_cols, "__b").orderBy(order_col)
    inside = w.rowsBetween(Window.unboundedPreceding, -1)
    out = j.withColumns({f"before_{c}": F.col(f"__o_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))
                         for c in sum_cols})
    if previous:
        out = out.withColumn("__before", F.coalesce(F.lag(before).over(w), F.col("__border")))
        out = out.withColumns({f"prev_{c}": F.col(f"__before.{c}") for c in previous}).drop("__before", "__border")
    return out.drop("__x", "__b", *[f"__o_{c}" for c in sum_cols])
