"""Data quality and headline counts.

Every profile is a single aggregate pass with map-side partial aggregation; the
long form is produced by ``stack`` on the one-row result, not by extra jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Zeros and NULLs per column in one pass -> (column, n_rows, n_zero, n_null)."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c) == 0).alias(f"z_{i}"), F.count_if(F.col(c).isNull()).alias(f"u_{i}")]
    one = df.agg(*aggs)
    parts = []
    for i, c in enumerate(cols):
        parts += [f"'{c}'", f"z_{i}", f"u_{i}"]
    return one.selectExpr("n_rows", f"stack({len(cols)}, {', '.join(parts)}) AS (column, n_zero, n_null)") \
              .select("column", "n_rows", "n_zero", "n_null")


def kpis(df: DataFrame, label: str, mean_cols: Sequence[str], zero_missing: Sequence[str] = (),
         zeros_as_missing: bool = True) -> DataFrame:
    """A1/A2: total, positives, negatives, prevalence %, feature means (one row).

    ``zeros_as_missing=False`` reproduces a profile on raw zeros.
    """
    aggs = [F.count(F.lit(1)).alias("n_total"),
            F.count_if(F.col(label) == 1).alias("n_positive"),
            F.count_if(F.col(label) == 0).alias("n_negative")]
    for c in mean_cols:
        x = F.col(c).cast("double")
        if zeros_as_missing and c in zero_missing:
            x = F.expr(f"nullif(CAST(`{c}` AS DOUBLE), 0)")
        aggs.append(F.round(F.avg(x), 6).alias(f"mean_{c}"))
    out = df.agg(*aggs)
    return out.withColumn(
        "prevalence_pct",
        F.round(F.try_divide(F.col("n_positive").cast("double") * 100.0, F.col("n_total").cast("double")), 6))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """A3: rows per label value, most frequent first."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(label))


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """L1: first n rows under a total order (TakeOrderedAndProject: per-task top-n)."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in order]).limit(n)
