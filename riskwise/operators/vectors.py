"""Vector features (``array<float>`` columns): A4, A7 and M3 for wide features.

Arrays become ML vectors with ``array_to_vector``; statistics over many
dimensions use Spark ML's summarisers, whose partial results are bounded by the
dimension (d or d x d), not by the row count.
"""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_vector(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(col)))


def vector_group_means(df: DataFrame, label: str, col: str, digits: int = 6) -> DataFrame:
    """A4 per dimension: (label, dim, mean) with one grouped pass (map-side partial)."""
    return (df.select(label, F.posexplode(col).alias("dim", "v"))
            .groupBy(label, "dim").agg(F.round(F.avg(F.col("v").cast("double")), digits).alias("mean")))


def vector_corr(df: DataFrame, col: str, digits: int = 6) -> DataFrame:
    """A7 for wide vectors: Pearson matrix as (dim_a, dim_b, r).

    ``Correlation.corr`` tree-aggregates a d x d Gramian; its one-row result (a
    d x d matrix: bounded by the dimension, never by the row count) is reshaped
    into rows.  Meant for dense vectors up to a few thousand dimensions.  A
    constant dimension gives NULL.
    """
    mat = Correlation.corr(to_vector(df.select(col), col), "features", "pearson").first()[0].toArray()
    n = len(mat)
    data = [(i, j, None if mat[i][j] != mat[i][j] else round(float(mat[i][j]), digits))
            for i in range(n) for j in range(n)]
    return df.sparkSession.createDataFrame(data, "dim_a int, dim_b int, r double")


def vector_standardize(df: DataFrame, key: str, col: str, digits: int = 6) -> DataFrame:
    """M3 on vectors: ``StandardScaler(withMean, withStd)`` (sample std), long form."""
    v = to_vector(df.select(key, col), col, "raw")
    model = StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True).fit(v)
    z = model.transform(v).select(key, vector_to_array("z").alias("z"))
    return z.select(key, F.posexplode("z").alias("dim", "z")).withColumn("z", F.round("z", digits))
