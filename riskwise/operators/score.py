"""Scoring with a fixed linear link (P8-P13, P20, E1, M14 without a learner).

``LinearRisk`` is the SQL-checkable form of the winning model: zeros -> NULL,
exact-median fill, z-score, ``intercept + w . z`` -> sigmoid -> threshold.  The
fitted state is two scalars per feature; scoring is one projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwise import roles
from riskwise.functions import columns as C
from riskwise.operators.prep import ImputeModel, ScaleModel, fit_impute, fit_scale


@dataclass
class LinearRisk:
    features: tuple
    zero_missing: tuple
    weights: tuple
    intercept: float
    impute: ImputeModel
    scale: ScaleModel
    threshold: float = roles.DECISION_THRESHOLD

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str], zero_missing: Sequence[str],
            weights: Sequence[float], intercept: float, ddof: int = 1) -> "LinearRisk":
        clean = C.zeros_to_null(df.select(*features), zero_missing)
        imp = fit_impute(clean, zero_missing, "median")
        filled = imp.transform(clean)
        sc = fit_scale(filled, features, ddof=ddof, suffix="__z")
        return cls(tuple(features), tuple(zero_missing), tuple(weights), float(intercept), imp, sc)

    @classmethod
    def for_role(cls, df: DataFrame, role: roles.Role) -> "LinearRisk":
        return cls.fit(df, role.features, role.zero_missing, role.weights, role.intercept)

    def zcols(self) -> list:
        return [f"{c}__z" for c in self.features]

    def transform(self, df: DataFrame, keep_z: bool = False) -> DataFrame:
        """Adds ``p`` (risk probability), ``prediction`` (0/1) and ``risk_pct``."""
        out = self.scale.transform(self.impute.transform(C.zeros_to_null(df, self.zero_missing)))
        out = (out.withColumn("margin", C.linear_margin(self.zcols(), self.weights, self.intercept))
               .withColumn("p", C.sigmoid("margin"))
               .withColumn("prediction", (F.col("p") > self.threshold).cast("int"))
               .withColumn("risk_pct", C.risk_pct("p", 1)))
        if not keep_z:
            out = out.drop(*self.zcols())
        return out

    def contributions(self, df: DataFrame, key: Sequence[str]) -> DataFrame:
        """Exact per-feature term ``w_i * z_i`` of the linear margin, long form."""
        scored = self.transform(df, keep_z=True)
        terms = F.array(*[F.struct(F.lit(f).alias("feature"),
                                   (F.lit(w) * F.col(z)).alias("contribution"))
                          for f, w, z in zip(self.features, self.weights, self.zcols())])
        return scored.select(*key, F.inline(terms))


def band_summary(scored: DataFrame, p_col: str = "p") -> DataFrame:
    """Step-1 query output: rows, mean probability per risk band."""
    return (scored.withColumn("band", C.risk_band(F.col(p_col) * 100.0))
            .groupBy("band")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(p_col), 6).alias("avg_p")))
