"""End-to-end jobs of the clinical application, built from the library operators.

``train_and_select``: measurement table -> zeros as NULL -> reproducible split ->
fold-wise CV for each classifier family -> champion on mean CV ROC-AUC -> saved
pipeline, metrics table (JSON), coefficients, held-out predictions (parquet).

``score_records``: scoring records -> schema enforcement -> saved pipeline ->
risk %, diagnosis, band, guidance and report text as columns.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwise import roles
from riskwise.functions import columns as C
from riskwise.operators import evaluate as EV
from riskwise.operators import quarantine as QR
from riskwise.operators import split as SP
from riskwise.plans import learners as L
from riskwise.sources import files


def train_and_select(spark: SparkSession, df: DataFrame, out_dir: str,
                     features: Sequence[str] = roles.CLINICAL_FEATURES,
                     zero_missing: Sequence[str] = roles.CLINICAL_ZERO_MISSING,
                     label: str = roles.CLINICAL_LABEL, key: Sequence[str] | None = None,
                     grid: dict = L.FULL_GRID, test_pct: int = 20) -> dict:
    """Returns paths and the champion name; every artefact is a distributed write.

    Rows that cannot be trained on (a feature that is not imputed or a label missing, text for a number)
    are written to ``rejected_rows`` with their reasons and take no part.
    """
    check = training_check(df, features, zero_missing, label)
    rows, paths = QR.checked(df, check, [c for c in key or () if c not in check.schema.names]), {"rejects": f"{out_dir}/rejected_rows"}
    rows.where("not accepted").select("entered.*", "reasons").write.mode("overwrite").parquet(paths["rejects"])
    df = rows.where("accepted").drop("accepted", "entered", "reasons")
    key = list(key) if key else list(features) + [label]  # no id column: hash the whole record
    data = SP.hash_split(L.prepare(df, features, zero_missing), key, test_pct)
    train, test = data.where("split = 'train'").persist(), data.where("split = 'test'").persist()
    with L.prepare_folds(train, features, zero_missing, label, key) as folds:
        results = {name: L.tune(train, name, grid[name], features, zero_missing, label, key, prepared=folds)
                   for name in L.MODEL_ORDER if name in grid}
    order = {n: i for i, n in enumerate(L.MODEL_ORDER)}
    cv = spark.createDataFrame([(n, float(r.cv_auc)) for n, r in results.items()], "model string, roc_auc double")
    champion = EV.leaderboard(cv, order).where("champion").first()["model"]
    metrics = None
    for name, r in results.items():
        m = L.test_metrics(r.model, test, name, label)
        metrics = m if metrics is None else metrics.unionByName(m)
    paths |= {"model": f"{out_dir}/best_model", "metrics": f"{out_dir}/model_comparison",
             "predictions": f"{out_dir}/test_predictions", "coefficients": f"{out_dir}/coefficients", "document": f"{out_dir}/model_document", "accuracy": f"{out_dir}/accuracy_by_side"}
    L.save_model(results[champion].model, paths["model"])
    files.write_metrics_json(metrics, paths["metrics"])
    sides = [L.accuracy_by_side(r.model, train, test, name, label) for name, r in results.items()]
    functools.reduce(DataFrame.unionByName, sides).write.mode("overwrite").parquet(paths["accuracy"])
    pred = L.predictions(results[champion].model, test, label, list(features))
    pred.write.mode("overwrite").parquet(paths["predictions"])
    linear = None
    if "LogisticRegression" in results:
        last = results["LogisticRegression"].model.stages[-1]
        linear = ("LogisticRegression", list(features), [float(w) for w in last.coefficients.toArray()],
                  float(last.intercept))
        L.coefficients(results["LogisticRegression"].model, features).write.mode("overwrite").parquet(
            paths["coefficients"])
    files.write_metrics_document(files.read_metrics_json(spark, paths["metrics"]), L.MODEL_ORDER, linear,
                                 paths["document"])
    train.unpersist()
    test.unpersist()
    return {"champion": champion, **paths}


def training_check(df: DataFrame, features: Sequence[str], zero_missing: Sequence[str], label: str) -> QR.Check:
    """M2: numeric features, of which those that are imputed may be missing, and a label of 0 or 1."""
    whole = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)
    fields = [T.StructField(c, df.schema[c].dataType if isinstance(df.schema[c].dataType, whole) else T.DoubleType())
              for c in features]
    return QR.Check(T.StructType([*fields, T.StructField(label, T.IntegerType())]), tuple(zero_missing), ((label, (0, 1)),))


SCORING_CHECK = QR.Check(roles.SCORING_SCHEMA, roles.CLINICAL_ZERO_MISSING)


def score_checked(records: DataFrame, model_path: str, check: QR.Check = SCORING_CHECK,
                  zero_missing: Sequence[str] = roles.CLINICAL_ZERO_MISSING, keep: Sequence[str] = ()) -> DataFrame:
    """M2 + S1: every record, scored if it passes the check, else with its reasons (see ``learners.score_checked``)."""
    out = L.score_checked(L.load_model(model_path), records, check, zero_missing, keep)
    return out.withColumns({"outcome": C.outcome_word("prediction"), "band": C.risk_band(F.col("p") * 100.0)})


# a zero stands for a missing value and must stay one
FEED_CLIP = {c: b for c, b in roles.CLINICAL_CLIP.items() if c not in roles.CLINICAL_ZERO_MISSING}
FEED_VITALS = ("Glucose", "BloodPressure", "BMI", "Age")


def clinical_feed(records: DataFrame, model_path: str, id_col: str, time_col: str, vitals: Sequence[str] = FEED_VITALS) -> DataFrame:
    """T1, T2 for clinical records, a table or a stream: one feed row per arriving record.

    (id, time, tag, clock, the vitals as numbers, risk_pct, diagnosis, accepted, reasons); values are clipped as the feed
    clips them before scoring, and a record that cannot be scored is a row without risk and diagnosis, with its reasons.
    """
    out = L.score_checked(L.load_model(model_path), records, SCORING_CHECK, roles.CLINICAL_ZERO_MISSING, [id_col, time_col],
                          clip=FEED_CLIP)
    return out.select(id_col, time_col, C.record_tag(id_col).alias("tag"), C.clock(time_col).alias("clock"),
                      *[F.col(f"entered.{c}").try_cast("double").alias(c) for c in vitals], "risk_pct",
                      C.outcome_word("prediction", roles.FEED_DIAGNOSIS).alias("diagnosis"), "accepted", "reasons")


def score_records(records: DataFrame, model_path: str,
                  zero_missing: Sequence[str] = roles.CLINICAL_ZERO_MISSING) -> DataFrame:
    """M14 + P8-P15: score every record with the saved pipeline."""
    model = L.load_model(model_path)
    fields = roles.SCORING_SCHEMA.fieldNames()
    raw = files.to_frame(records, roles.SCORING_SCHEMA, strict=False).withColumn("entered", F.struct(*fields))
    out = model.transform(C.zeros_to_null(raw, zero_missing))
    # guidance and report judge and print what was entered, not what scoring filled in
    out = out.select("entered.*", F.col("prediction").cast("int").alias("prediction"), C.scored_risk(out).alias("p"))
    return out.select(
        *fields, "prediction", F.col("p").alias("probability"),
        C.outcome_word("prediction").alias("outcome"),
        C.risk_pct("p", 1).alias("risk_pct"),
        C.risk_band(F.col("p") * 100.0).alias("band"),
        C.guidance_text(roles.CLINICAL_GUIDANCE, roles.CLINICAL_GUIDANCE_DEFAULT).alias("guidance"),
        C.report_text(roles.CLINICAL_REPORT, roles.CLINICAL_GUIDANCE, roles.CLINICAL_GUIDANCE_DEFAULT,
                      "prediction", "p", zero_missing).alias("report"),
    )
