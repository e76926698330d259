"""The clinical job end to end on a clinical-shaped table derived from lineitem."""

from pyspark.sql import functions as F

from riskwise import roles
from riskwise.plans import learners as L
from riskwise.plans import workflow
from riskwise.session import scratch_path, table

from .conftest import SF_SMALL


def _clinical(spark):
    li = table(spark, SF_SMALL, "lineitem")
    return li.select(
        F.col("l_linenumber").cast("int").alias("Pregnancies"),
        (F.col("l_quantity") * 4).cast("int").alias("Glucose"),
        (F.col("l_discount") * 1000).cast("int").alias("BloodPressure"),
        (F.col("l_tax") * 500).cast("int").alias("SkinThickness"),
        (F.col("l_extendedprice") / 100).cast("int").alias("Insulin"),
        (F.col("l_extendedprice") / 2000).alias("BMI"),
        (F.col("l_partkey") % 100 / 50.0).alias("DiabetesPedigreeFunction"),
        (20 + F.col("l_suppkey") % 60).cast("int").alias("Age"),
        (F.col("l_returnflag") == "R").cast("int").alias("Outcome"))


def test_train_select_save_and_score(spark):
    df = _clinical(spark)
    out = scratch_path(spark, "clinical")
    grid = {"LogisticRegression": L.WALKTHROUGH_GRID["LogisticRegression"], "DecisionTree": {"maxDepth": [3]}}
    res = workflow.train_and_select(spark, df, out, grid=grid)
    assert res["champion"] in grid
    metrics = spark.read.json(res["metrics"])
    assert metrics.count() == 10 and set(r["metric"] for r in metrics.collect()) == set(
        ("accuracy", "roc_auc", "f1_score", "precision", "recall"))
    sides = {(r["model"], r["side"]): r for r in spark.read.parquet(res["accuracy"]).collect()}
    held = {r["model"]: r["score"] for r in metrics.where("metric = 'accuracy'").collect()}
    assert set(sides) == {(m, s) for m in grid for s in ("train", "test")}
    assert all(abs(sides[m, "test"]["accuracy"] - a) < 1e-6 for m, a in held.items())
    assert sides["DecisionTree", "train"]["n"] + sides["DecisionTree", "test"]["n"] == df.count()
    feed = workflow.clinical_feed(df.withColumn("id", F.monotonically_increasing_id()).withColumn("at", F.lit("2024-01-01 10:20:30").cast("timestamp_ntz"))
                                  .withColumn("Age", F.expr("if(id = 3, null, Age)")), res["model"], "id", "at")
    assert feed.columns == ["id", "at", "tag", "clock", "Glucose", "BloodPressure", "BMI", "Age", "risk_pct", "diagnosis", "accepted", "reasons"]
    shown = {r["id"]: r for r in feed.where("id < 6").collect()}
    assert shown[2]["tag"] == "PT-0002" and shown[2]["clock"] == "10:20:30" and shown[2]["diagnosis"] in roles.FEED_DIAGNOSIS
    assert shown[3]["reasons"] == ["Age: missing"] and shown[3]["risk_pct"] is None and shown[3]["diagnosis"] is None
    coefs = spark.read.parquet(res["coefficients"]).collect()
    assert [r["feature"] for r in coefs][:8] == list(roles.CLINICAL_FEATURES)
    scored = workflow.score_records(df.drop("Outcome").limit(50), res["model"])
    rows = scored.collect()
    assert len(rows) == 50
    assert all(0.0 <= r["probability"] <= 1.0 and r["band"] in roles.BAND_NAMES for r in rows)
    assert all((r["probability"] > 0.5) == (r["prediction"] == 1) for r in rows if res["champion"] ==
               "LogisticRegression")


def test_cli_score(spark):
    from riskwise import cli
    df = _clinical(spark)
    out = scratch_path(spark, "clinical-cli")
    res = workflow.train_and_select(spark, df, out, grid={"LogisticRegression": {"regParam": [0.01]}})
    records = scratch_path(spark, "records")
    df.drop("Outcome").limit(30).write.option("header", True).csv(records)
    scored = scratch_path(spark, "scored")
    cli.main(["score", res["model"], records, scored])
    rows = spark.read.parquet(scored).collect()
    assert len(rows) == 30 and all(r["band"] in roles.BAND_NAMES for r in rows)
