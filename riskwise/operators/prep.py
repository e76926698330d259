"""Feature preparation: imputation surrogates, standardisation.

Fitting produces a handful of scalars per column (bounded, like Spark ML's own
``Imputer``/``StandardScaler`` models); transforming applies them as literals in
one projection, so scoring is a narrow, codegen'd map with no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwise.operators.quantiles import exact_quantiles, valid


@dataclass
class ImputeModel:
    surrogates: dict  # column -> fill value
    suffix: str = ""

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}{self.suffix}": F.coalesce(valid(c), F.lit(v))
                               for c, v in self.surrogates.items()})

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame([(c, float(v)) for c, v in self.surrogates.items()],
                                     "column string, surrogate double")


def fit_impute(df: DataFrame, cols: Sequence[str], strategy: str = "median",
               suffix: str = "") -> ImputeModel:
    """Surrogate per column over the values that are not NULL or NaN; both are filled.

    ``median`` is the exact lower median (``percentile_disc(0.5)``), ``median_cont``
    the interpolated one, ``mean`` the average, ``mode`` the most frequent value
    (smallest on ties).  A column with no values raises, like ``Imputer``.
    """
    cols = list(cols)
    if not cols:
        return ImputeModel({}, suffix)
    if strategy in ("median", "median_cont"):
        q = exact_quantiles(df, cols, [0.5], "disc" if strategy == "median" else "cont")
        sur = {c: q[(c, 0.5)] for c in cols}
    elif strategy == "mean":
        row = df.agg(*[F.avg(valid(c)).alias(c) for c in cols]).first()
        sur = {c: row[c] for c in cols}
    elif strategy == "mode":
        sur = {}
        for c in cols:  # one grouped aggregate per column; groups = distinct values
            r = (df.where(valid(c).isNotNull()).groupBy(c).count()
                 .orderBy(F.desc("count"), F.asc(c)).limit(1).first())
            sur[c] = None if r is None else float(r[c])
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    missing = [c for c, v in sur.items() if v is None]
    if missing:
        raise ValueError(f"surrogate cannot be computed: no values in {missing}")
    return ImputeModel(sur, suffix)


@dataclass
class ScaleModel:
    mean: dict
    std: dict
    with_mean: bool = True
    with_std: bool = True
    suffix: str = ""

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c in self.mean:
            e = F.col(c).cast("double")
            if self.with_mean:
                e = e - F.lit(self.mean[c])
            if self.with_std:
                s = self.std[c]
                # a constant column scales to 0 (as StandardScaler does), never inf/NaN
                e = e / F.lit(s) if s not in (None, 0.0) else F.lit(0.0) * e
            out[f"{c}{self.suffix}"] = e
        return df.withColumns(out)


def fit_scale(df: DataFrame, cols: Sequence[str], ddof: int = 1, with_mean: bool = True,
              with_std: bool = True, suffix: str = "") -> ScaleModel:
    """A10/M3: mean and std per column in one aggregate.

    ``ddof=1`` is the sample std used by ``StandardScaler``; ``ddof=0`` the
    population std of the single-machine scaler.
    """
    fn = F.stddev_samp if ddof == 1 else F.stddev_pop
    aggs = []
    for i, c in enumerate(cols):
        x = valid(c)
        aggs += [F.avg(x).alias(f"m{i}"), fn(x).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return ScaleModel({c: row[f"m{i}"] for i, c in enumerate(cols)},
                      {c: row[f"s{i}"] for i, c in enumerate(cols)},
                      with_mean, with_std, suffix)
