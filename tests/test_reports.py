"""Report text on entered values, label fallback, exact ROC points, metrics document, sketches of empty columns."""

import pytest
from pyspark.sql import functions as F

from riskwise.functions import columns as C
from riskwise.operators import evaluate as EV
from riskwise.operators.quantiles import exact_quantiles
from riskwise.plans import learners as L
from riskwise.sources import files


def test_report_prints_entered_values(spark):
    df = spark.createDataFrame([(0.0, 2.0, 1, 0.25), (None, 9.5, 0, 0.5)], "a double, b double, prediction int, p double")
    text = C.report_text([("a", "A", "%.1f", "mm"), ("b", "B", "%.1f", "")], [("b", 5.0, "b is high")], "fine",
                         "prediction", "p", imputed=["a"])
    one, two = [r[0].split("\n") for r in df.orderBy("p").select(text).collect()]
    assert one == ["MEASUREMENTS:", "- A: 0.0 mm", "- B: 2.0", "OUTCOME:", "- Predictive Diagnostic: POSITIVE",
                   "- Confidence Score: 25.00%", "- Imputed for scoring: a", "GUIDANCE:", "fine"]
    assert two[1] == "- A: not measured" and "- Imputed for scoring: a" in two and two[-1] == "b is high"


def test_scored_risk_falls_back_to_the_label(spark):
    df = spark.createDataFrame([(1,), (0,)], "prediction int").withColumn("rawPrediction", F.lit(None))
    assert sorted(r[0] for r in df.select(C.scored_risk(df)).collect()) == [0.0, 1.0]


def test_roc_points_are_exact(spark):
    rows = [(0.9, 1), (0.9, 0), (0.8, 1), (0.3, 0), (0.3, 1), (0.1, 0), (None, 1), (float("nan"), 0)]
    df = spark.createDataFrame(rows, "p double, label int")
    kept = [(p, y) for p, y in rows if p is not None and p == p]
    got = {r["threshold"]: (r["tp"], r["fp"]) for r in EV.roc_points(df).collect()}
    assert got == {t: (sum(y for p, y in kept if p >= t), sum(1 - y for p, y in kept if p >= t)) for t, _ in kept}
    assert EV.roc_points(df.limit(0)).count() == 0
    assert EV.trapezoid_auc(EV.roc_curve(df)).first()[0] == EV.auc_exact(df).first()[0]


def test_bucketed_roc_needs_probabilities(spark):
    with pytest.raises(Exception, match="0..1"):
        EV.roc_curve(spark.createDataFrame([(1.5, 1), (0.2, 0)], "p double, label int")).collect()


def test_quantiles_of_empty_and_null_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (float("nan"), None)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5], "cont") == {("a", 0.5): 1.5, ("b", 0.5): None}
    assert exact_quantiles(df.limit(0), ["a"], [0.5]) == {("a", 0.5): None}


def test_load_model_names_the_missing_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="run training first"):
        L.load_model(str(tmp_path / "none"))
    (tmp_path / "broken" / "metadata").mkdir(parents=True)
    (tmp_path / "broken" / "metadata" / "part-00000").write_text("not a model\n")
    with pytest.raises(Exception) as e:
        L.load_model(str(tmp_path / "broken"))
    assert not isinstance(e.value, FileNotFoundError)


def test_metrics_document_keeps_the_first_of_equal_models(spark, tmp_path):
    tall = spark.createDataFrame([("x", "roc_auc", 0.7), ("y", "roc_auc", 0.7), ("y", "recall", None)],
                                 "model string, metric string, score double")
    path = str(tmp_path / "doc")
    files.write_metrics_document(tall, ["y", "x"], ("x", ["a"], [1.5], -0.5), path)
    got = {tuple(r) for r in files.read_metrics_document(spark, path).collect()}
    assert {("meta", "y", "best_roc_auc", 0.7), ("coefficient", "x", "a", 1.5), ("coefficient", "x", "(intercept)", -0.5),
            ("metric", "x", "roc_auc", 0.7)} <= got
    files.write_metrics_document(tall.limit(0), ["x"], None, path)
    assert files.read_metrics_document(spark, path).count() == 0


def test_saved_pipeline_scores_a_stream_like_a_table(spark, tmp_path):
    from pyspark.ml import Pipeline

    from riskwise.streaming import feed as ST
    rows = [(i, float(i % 7), float(i % 5) if i % 4 else 0.0, int(i % 7 > 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    for name in ("LogisticRegression", "SupportVectorMachine"):
        model = Pipeline(stages=[*L.prep_pipeline(["a", "b"], ["b"]).getStages(), L.make_classifier(name, "y")]).fit(
            L.prepare(df, ["a", "b"], ["b"]))
        odd = df.drop("y").unionByName(spark.createDataFrame([(900, None, 2.0), (901, 99.0, None)], df.drop("y").schema)
                                       .fillna(3.0, ["a"]))
        src = str(tmp_path / name)
        odd.repartition(3).write.parquet(src)

        def score(x):
            return L.score_records(model, x, ["a", "b"], ["b"], ["id"], {"a": (0.0, 10.0)})

        stream = spark.readStream.schema(odd.schema).option("maxFilesPerTrigger", 1).parquet(src)
        live = spark.read.parquet(ST.append_stream(spark, score(stream), "t", str(tmp_path / f"{name}-out")))
        got, want = (sorted(map(tuple, x.collect()), key=lambda r: r[0]) for x in (live, score(odd)))
        assert got == want and len(got) == 202
        assert got[-1][1:3] == (99.0, None)          # as entered
        if name == "SupportVectorMachine":
            assert {r[-2] for r in got} <= {0.0, 1.0}
