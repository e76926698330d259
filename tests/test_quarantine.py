"""Records that cannot be scored are kept with their reasons; none ends a batch or a stream."""

import json

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import types as T

from riskwise import cli, roles
from riskwise.operators import quarantine as QR
from riskwise.plans import learners as L
from riskwise.plans import workflow
from riskwise.session import scratch_path
from riskwise.sources import files
from riskwise.streaming import feed as ST

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.DoubleType())])
CHECK = QR.Check(SCHEMA, ("c",))
CASES = [  # id, a, b, c, reasons
    (1, "1", "2.5", "3", []), (2, " 2 ", "1e3", "", []), (3, "4.0", "0", None, []), (4, "4.5", "1", "1", ["a: not int"]),
    (5, None, "1", "NaN", ["a: missing"]), (6, "x", "NaN", "y", ["a: not int", "b: NaN", "c: not double"]),
    (7, "99999999999", "Infinity", "-Infinity", ["a: not int", "b: not finite", "c: not finite"]), (8, "", " ", "1", ["a: missing", "b: missing"])]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame([c[:4] for c in CASES], "id int, a string, b string, c string")


def test_reasons_per_field(records):
    rows = {r["id"]: r for r in QR.checked(records, CHECK, ["id"]).collect()}
    assert {i: r["reasons"] for i, r in rows.items()} == {c[0]: c[4] for c in CASES}
    assert (rows[1]["a"], rows[1]["b"], rows[1]["c"]) == (1, 2.5, 3.0)
    assert (rows[2]["a"], rows[2]["b"], rows[2]["c"], rows[3]["a"]) == (2, 1000.0, None, 4)
    assert rows[6]["entered"].asDict() == {"a": "x", "b": "NaN", "c": "y"}


def test_accepted_and_rejected_are_the_input(spark, records):
    good, bad = QR.split(records, CHECK, ["id"])
    assert good.columns == ["id", "a", "b", "c"] and bad.columns == ["id", "a", "b", "c", "reasons"]
    assert sorted([r["id"] for r in good.collect()] + [r["id"] for r in bad.collect()]) == [c[0] for c in CASES]
    assert {r["id"]: r["a"] for r in bad.collect()}[6] == "x"
    counts = {r["reason"]: r["n"] for r in QR.rejects(QR.checked(records, CHECK)).collect()}
    assert counts["a: missing"] == 2 and sum(counts.values()) == sum(len(c[4]) for c in CASES)
    empty = QR.split(spark.createDataFrame([], records.schema), CHECK, ["id"])
    assert [e.count() for e in empty] == [0, 0]


def test_absent_fields_typed_columns_and_allowed_values(spark):
    check = QR.Check(SCHEMA, ("c",), (("a", (0, 1)),))
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (0.5, float("nan")), (None, float("inf"))], "a double, b double")
    assert [r["reasons"] for r in QR.checked(df, check).collect()] == [
        [], ["a: not one of 0, 1"], ["a: not int", "b: NaN"], ["a: missing", "b: not finite"]]
    assert QR.checked(df.select("a"), check).first()["reasons"] == ["b: no such field"]


def test_lines_with_too_few_or_too_many_fields(spark):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([("1,2,3",), ("1,2",), ("1,2,3,4",), ("oops",), ("7,8,",)], "value string").coalesce(1).write.text(path)
    recs = files.read_csv_records(spark, path, SCHEMA, header=False)
    good, bad = QR.split(recs, CHECK)
    assert sorted(r["a"] for r in good.collect()) == [1, 7]
    assert all(r["reasons"][0] == "malformed line" for r in bad.collect()) and bad.count() == 3
    assert files.read_csv(spark, path, None, header=False).dtypes[0] == ("_c0", "string")      # inferred


CLEAN = [(1, 120.0, 70.0, 20.0, 80.0, 25.5, 0.4, 30, 0), (4, 180.0, 80.0, 30.0, 150.0, 35.5, 0.9, 50, 1),
         (0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.2, 22, 0), (8, 160.0, 90.0, 35.0, 0.0, 33.0, 0.7, 60, 1),
         (2, 110.0, 65.0, 22.0, 90.0, 28.0, 0.3, 27, 0), (6, 150.0, 85.0, 28.0, 130.0, 31.0, 1.1, 45, 1)] * 4


@pytest.fixture(scope="module")
def model_path(spark):
    df = spark.createDataFrame(CLEAN, T.StructType([*roles.SCORING_SCHEMA.fields, T.StructField("Outcome", T.IntegerType())]))
    prep = L.prep_pipeline(roles.CLINICAL_FEATURES, roles.CLINICAL_ZERO_MISSING).getStages()
    path = scratch_path(spark, "quarantine-model")
    train = L.prepare(df, roles.CLINICAL_FEATURES, roles.CLINICAL_ZERO_MISSING)
    L.save_model(Pipeline(stages=[*prep, L.make_classifier("LogisticRegression", "Outcome")]).fit(train), path)
    return path


BAD = [(1, 120.0, 70.0, 20.0, 80.0, 25.5, 0.4, None), (None, 120.0, 70.0, 20.0, 80.0, 25.5, 0.4, 30),
       (1, 120.0, 70.0, 20.0, 80.0, 25.5, float("nan"), 30), (1, float("inf"), 70.0, 20.0, 80.0, 25.5, 0.4, 30)]


def test_saved_pipeline_scores_all_but_the_bad_records(spark, model_path):
    good = [r[:8] for r in CLEAN[:6]] + [(1, None, float("nan"), 20.0, 80.0, 25.5, 0.4, 30)]
    records = spark.createDataFrame([(i, *r) for i, r in enumerate(good + BAD)],
                                    T.StructType([T.StructField("id", T.IntegerType()), *roles.SCORING_SCHEMA.fields]))
    out = {r["id"]: r for r in workflow.score_checked(records, model_path, keep=["id"]).collect()}
    assert [out[i]["accepted"] for i in range(11)] == [True] * 7 + [False] * 4
    assert [out[i]["reasons"] for i in range(7, 11)] == [["Age: missing"], ["Pregnancies: missing"],
                                                         ["DiabetesPedigreeFunction: NaN"], ["Glucose: not finite"]]
    want = workflow.score_records(records.where("id < 7").drop("id"), model_path)
    assert sorted(round(r["probability"], 12) for r in want.collect()) == sorted(round(out[i]["p"], 12) for i in range(7))
    assert all(out[i][c] is None for i in range(7, 11) for c in ("p", "prediction", "risk_pct", "outcome", "band"))


def test_stream_equals_batch_and_outlives_bad_records(spark, model_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), *roles.SCORING_SCHEMA.fields])
    folder = scratch_path(spark, "arriving")
    rows = [(i, *r) for i, r in enumerate([*BAD, *[r[:8] for r in CLEAN], *BAD])]
    for k in range(4):      # the first and the last file hold bad records
        spark.createDataFrame(rows[k * 8:(k + 1) * 8], schema).coalesce(1).write.parquet(f"{folder}/part{k}")
    model = L.load_model(model_path)

    def scored(records):
        return L.score_checked(model, records, workflow.SCORING_CHECK, roles.CLINICAL_ZERO_MISSING, ["id"])

    source = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder))
    sink = ST.append_stream(spark, scored(source), "checked-stream", partition_by=("accepted",))

    def key(df):
        return sorted((r["id"], r["accepted"], tuple(r["reasons"]), r["p"] and round(r["p"], 12)) for r in df.collect())

    batch = key(scored(spark.createDataFrame(rows, schema)))
    assert key(QR.read_checked(spark, sink)) == batch and sum(not b[1] for b in batch) == 8
    out = scratch_path(spark, "checked-batch")
    QR.write_checked(scored(spark.createDataFrame(rows, schema)), out)
    assert key(QR.read_checked(spark, out)) == batch
    assert spark.read.parquet(f"{out}/accepted=false").count() == 8


def test_training_leaves_out_rows_it_cannot_use(spark):
    df = spark.createDataFrame([*CLEAN, *[(*b, 1) for b in BAD], (*CLEAN[0][:8], None), (*CLEAN[0][:8], 7)],
                               T.StructType([*roles.SCORING_SCHEMA.fields, T.StructField("Outcome", T.IntegerType())]))
    check = workflow.training_check(df, roles.CLINICAL_FEATURES, roles.CLINICAL_ZERO_MISSING, "Outcome")
    good, bad = QR.split(df, check)
    assert good.count() == len(CLEAN)
    assert {r["reason"] for r in QR.rejects(QR.checked(df, check)).collect()} >= {"Age: missing", "Outcome: missing", "Outcome: not one of 0, 1"}
    assert bad.count() == 6


def test_command_line_writes_scores_and_rejects(spark, model_path, capsys):
    path, out = scratch_path(spark, "csv"), scratch_path(spark, "scored")
    lines = [",".join(roles.CLINICAL_FEATURES), "1,120,70,20,80,25.5,0.4,30", "1,120,70,20,80,25.5,0.4,", "1,0,0,0,0,0,0.4,30",
             "1,abc,70,20,80,25.5,0.4,30", "1,120"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    cli.main(["score", model_path, path, out])
    said = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert spark.read.parquet(out).count() == 2
    bad = spark.read.parquet(said["rejects"])
    assert sorted(r["reasons"][0] for r in bad.collect()) == ["Age: missing", "Glucose: not double", "malformed line"]
