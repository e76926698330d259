"""Descriptive statistics (A4-A7): group means, describe, histograms, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwise.operators.quantiles import exact_quantiles


def group_means(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """A4: mean of every feature per label value."""
    return df.groupBy(label).agg(*[F.round(F.avg(F.col(c).cast("double")), 6).alias(f"mean_{c}")
                                   for c in cols])


DESCRIBE_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()), T.StructField("count", T.LongType()),
    T.StructField("mean", T.DoubleType()), T.StructField("std", T.DoubleType()),
    T.StructField("min", T.DoubleType()), T.StructField("p25", T.DoubleType()),
    T.StructField("p50", T.DoubleType()), T.StructField("p75", T.DoubleType()),
    T.StructField("max", T.DoubleType())])


def describe(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """A5: count, mean, sample std, min, interpolated quartiles, max per column.

    Moments come from one aggregate; quartiles from the exact distributed
    quantile operator (no column is ever gathered into one task).
    """
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], "cont")

    def r(v):
        return None if v is None else round(float(v), digits)

    rows = [(c, row[f"n{i}"], r(row[f"m{i}"]), r(row[f"s{i}"]), r(row[f"lo{i}"]),
             r(q[(c, 0.25)]), r(q[(c, 0.5)]), r(q[(c, 0.75)]), r(row[f"hi{i}"]))
            for i, c in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA)


def histogram_by_label(df: DataFrame, widths: dict, label: str) -> DataFrame:
    """(column, bin, label, n) with ``bin = floor(x / width)`` for every feature.

    One pass: each row emits one (column, bin) per feature, then a grouped count
    with partial aggregation (groups = columns x bins x labels).
    """
    arr = F.array(*[F.struct(F.lit(c).alias("column"),
                             F.floor(F.col(c).cast("double") / F.lit(float(w))).cast("bigint").alias("bin"))
                    for c, w in widths.items()])
    return (df.select(F.col(label).alias("label"), F.inline(arr))
            .where(F.col("bin").isNotNull())
            .groupBy("column", "bin", "label").agg(F.count(F.lit(1)).alias("n")))


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation for every ordered pair, pairwise-complete rows.

    One scan at any width: every row gives one element per pair of the upper triangle (and the diagonal), and each task
    sums these into one row of mergeable co-moments per pair before anything is shuffled.  A constant
    column, or a pair without complete rows, yields NULL.
    """
    cols = list(cols)
    spark = df.sparkSession
    at = range(len(cols))
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in at for j in at if i <= j])
    xs = F.array(*[F.col(c).cast("double") for c in cols])
    rows = df.select(xs.alias("xs"), F.inline(pairs)).select("i", "j", F.col("xs")[F.col("i")].alias("x"), F.col("xs")[F.col("j")].alias("y"))
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    sx, sy = F.stddev_samp(F.when(both, F.col("x"))), F.stddev_samp(F.when(both, F.col("y")))
    found = rows.groupBy("i", "j").agg(F.round(F.try_divide(F.covar_samp("x", "y"), sx * sy), digits).alias("r"))
    names = spark.createDataFrame([(min(i, j), max(i, j), cols[i], cols[j]) for i in at for j in at],
                                  "i int, j int, col_a string, col_b string")
    return names.join(found, ["i", "j"], "left").select("col_a", "col_b", "r")     # one row per ordered pair
