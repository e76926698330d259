"""Edge cases listed with the input fixtures."""

import math

import pytest
from pyspark.sql import functions as F

from riskwise.functions import columns as C
from riskwise.operators import stats
from riskwise.operators.prep import fit_scale


def test_constant_feature(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, c double")
    r = {(x["col_a"], x["col_b"]): x["r"] for x in stats.corr_matrix(df, ["a", "c"]).collect()}
    assert r[("a", "a")] == 1.0 and r[("a", "c")] is None and r[("c", "c")] is None
    z = fit_scale(df, ["c"], suffix="_z").transform(df).select("c_z").collect()
    assert [x[0] for x in z] == [0.0, 0.0, 0.0]


def test_single_row(spark):
    df = spark.createDataFrame([(3.0,)], "x double")
    d = stats.describe(df, ["x"]).first()
    assert d["count"] == 1 and d["std"] is None and d["p25"] == d["p75"] == 3.0


def test_zero_kept_where_valid(spark):
    df = spark.createDataFrame([(0, 0)], "Pregnancies int, Glucose int")
    r = C.zeros_to_null(df, ["Glucose"]).first()
    assert r["Pregnancies"] == 0 and r["Glucose"] is None


def test_margin_model_without_probability(spark):
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(float(i), int(i > 4)) for i in range(10)], "x double, label int")
    v = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    out = LinearSVC(maxIter=20).fit(v).transform(v)
    assert "probability" not in out.columns
    rows = out.select(C.risk_probability(out).alias("p"), "rawPrediction", "prediction").collect()
    for r in rows:
        assert r["p"] == pytest.approx(1.0 / (1.0 + math.exp(r["rawPrediction"][0])))
        assert (r["p"] > 0.5) == (r["prediction"] == 1.0)


def test_null_in_non_imputed_feature_fails_assembler(spark):
    from riskwise.plans.learners import prep_pipeline
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0), (None, 4.0)], "a double, b double")
    with pytest.raises(Exception):
        m = prep_pipeline(["a", "b"], ["b"]).fit(df)  # 'a' is not imputed: NULL must not pass silently
        m.transform(df).select(F.col("features")).collect()
