"""Sources and sinks.

Files are read with a declared schema (inference costs an extra pass and drifts
between int and double); sinks are distributed writes, never a driver collect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwise import roles


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = roles.CLINICAL_SCHEMA,
             header: bool = True) -> DataFrame:
    """Header CSV with a declared schema; malformed rows fail the job (``read_csv_records`` keeps them).

    ``schema=None`` lets Spark infer names and types, which takes another pass over the files.
    """
    reader = spark.read.option("header", header).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType = roles.SCORING_SCHEMA,
                     header: bool = True, corrupt: str = "_corrupt_record") -> DataFrame:
    """Every line of a CSV as a record of text fields, for ``operators.quarantine``.

    No line ends the job: a line with too few or too many fields comes with the fields that it has, and as a whole
    in the column ``corrupt``.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(corrupt, T.StringType())])
    return (spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt).option("columnPruning", False).csv(path))


def to_frame(df: DataFrame, schema: T.StructType = roles.SCORING_SCHEMA, strict: bool = True) -> DataFrame:
    """Enforce a record schema by name: cast every field, fail on a missing one.

    With ANSI mode a value that does not fit the type raises instead of turning
    into NULL.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing and strict:
        raise ValueError(f"records lack fields {missing}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


METRICS_SCHEMA = T.StructType([T.StructField("model", T.StringType()),
                               T.StructField("metric", T.StringType()),
                               T.StructField("score", T.DoubleType())])


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """Metrics table as JSON lines (one object per model/metric)."""
    metrics.write.mode("overwrite").json(path)


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """Read the metrics table back with its schema."""
    return spark.read.schema(METRICS_SCHEMA).json(path)


METRICS_DOCUMENT = ("models map<string,map<string,double>>, "
                    "linear struct<model:string,features:array<string>,coefficients:array<double>,intercept:double>, "
                    "meta struct<best_model_name:string,best_roc_auc:double>")


def write_metrics_document(metrics: DataFrame, order: Sequence[str], linear: tuple | None, path: str) -> None:
    """The whole comparison as one JSON document: every model's metrics, the linear model's
    (name, features, coefficients, intercept) and the best model with its ROC-AUC.

    The best model is the first in ``order`` of largest ``roc_auc``.  The document has one entry per model and
    metric and one per feature, so it is built from collected rows.
    """
    models: dict = {}
    for r in metrics.collect():
        models.setdefault(r["model"], {})[r["metric"]] = r["score"]
    ranked = [m for m in order if models.get(m, {}).get("roc_auc") is not None]
    best = max(ranked, key=lambda m: models[m]["roc_auc"], default=None)
    meta = (best, models[best]["roc_auc"]) if best else None
    metrics.sparkSession.createDataFrame([(models, linear, meta)], METRICS_DOCUMENT).coalesce(1).write.mode(
        "overwrite").json(path)


def read_metrics_document(spark: SparkSession, path: str) -> DataFrame:
    """The document as rows (section, name, item, value)."""
    doc = spark.read.schema(METRICS_DOCUMENT).json(path)
    scores = (doc.select(F.explode("models").alias("name", "m")).select("name", F.explode("m").alias("item", "value"))
              .select(F.lit("metric").alias("section"), "name", "item", "value"))
    weights = doc.where("linear is not null").select(
        F.lit("coefficient").alias("section"), F.col("linear.model").alias("name"), F.inline(F.concat(
            F.arrays_zip(F.col("linear.features").alias("item"), F.col("linear.coefficients").alias("value")),
            F.array(F.struct(F.lit("(intercept)").alias("item"), F.col("linear.intercept").alias("value"))))))
    best = doc.where("meta is not null").select(
        F.lit("meta").alias("section"), F.col("meta.best_model_name").alias("name"), F.lit("best_roc_auc").alias("item"),
        F.col("meta.best_roc_auc").alias("value"))
    return scores.unionByName(weights).unionByName(best)
