"""One rule for NULL and NaN: they are missing, never a value."""

import math

import pytest
from pyspark.sql import functions as F

from riskwise.functions import columns as C
from riskwise.operators import evaluate as EV
from riskwise.operators import feed as FD
from riskwise.operators.prep import fit_impute, fit_scale

NAN = float("nan")


def test_auc_leaves_unscored_rows_out(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.1, 0), (None, 0), (NAN, 1), (0.5, None)], "p double, label int")
    assert EV.auc_exact(df).first()["roc_auc"] == 1.0


def test_auc_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 0.9, 1), (None, 0.1, 0), ("a", 0.2, 1), ("a", 0.3, 0)], "g string, p double, label int")
    got = {r["g"]: r["roc_auc"] for r in EV.auc_exact(df, group_cols=["g"]).collect()}
    assert got == {None: 1.0, "a": 0.0}


def test_unpredicted_rows_count_as_wrong_and_odd_labels_fail(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (1, None), (0, 2)], "label int, prediction int")
    row = EV.classification_metrics(df).first()
    assert row["accuracy"] == row["recall"] == 0.5
    with pytest.raises(Exception, match="label other than 0 and 1"):
        EV.classification_metrics(df.withColumn("label", F.lit(2))).collect()


def test_clip_and_band_keep_missing(spark):
    df = spark.createDataFrame([(None,), (NAN,), (10.0,), (300.0,)], "x double")
    got = [tuple(r) for r in df.select(C.clip("x", 40, 250), C.risk_band(F.col("x"))).collect()]
    assert got == [(None, None), (None, None), (40.0, "low"), (250.0, "high")]


def test_nan_is_imputed_like_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (NAN,), (None,), (0.0,)], "x double")
    clean = C.zeros_to_null(df, ["x"])
    assert clean.where("x is null").count() == 3
    for strategy in ("median", "mean"):
        filled = fit_impute(clean, ["x"], strategy).transform(df)
        assert sorted(r["x"] for r in filled.collect()) == [0.0, 1.0, 2.0, 2.0, 2.0, 3.0]
    scale = fit_scale(clean, ["x"])
    assert scale.mean["x"] == 2.0 and math.isclose(scale.std["x"], 1.0)


def test_constant_feed_feature_and_malformed_attribute(spark):
    ev = spark.createDataFrame([(1, "a", 5.0, '{"k": 1}'), (2, "a", 5.0, '{"k": "x"}')],
                               "event_id long, event_type string, value double, props string").withColumn(
        "ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    out = FD.FeedScorer.fit(ev).transform(ev).orderBy("event_id").collect()
    assert 0 < out[0]["p"] < 1 and out[1]["p"] is None
