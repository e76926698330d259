import pytest
from pyspark.sql import functions as F

from riskwise import roles
from riskwise.session import scratch_path, table
from riskwise.sources import files

from .conftest import SF_SMALL


def test_csv_with_declared_schema_roundtrip(spark):
    li = table(spark, SF_SMALL, "lineitem")
    clinical = li.select(F.col("l_linenumber").alias("Pregnancies"), F.col("l_quantity").cast("int").alias("Glucose"),
                         F.lit(0).alias("BloodPressure"), F.lit(20).alias("SkinThickness"),
                         F.lit(0).alias("Insulin"), F.col("l_tax").alias("BMI"),
                         F.col("l_discount").alias("DiabetesPedigreeFunction"), F.lit(33).alias("Age"),
                         (F.col("l_returnflag") == "R").cast("int").alias("Outcome"))
    path = scratch_path(spark, "csv")
    clinical.write.option("header", True).csv(path)
    back = files.read_csv(spark, path)
    assert back.schema == roles.CLINICAL_SCHEMA
    assert back.count() == li.count()
    assert back.agg(F.sum("Outcome")).first()[0] == clinical.agg(F.sum("Outcome")).first()[0]


def test_to_frame_casts_and_rejects_missing_fields(spark):
    df = spark.createDataFrame([(6, 148, 72, 35, 0, 33.6, 0.627, 50)],
                               "Pregnancies long, Glucose long, BloodPressure long, SkinThickness long, "
                               "Insulin long, BMI double, DiabetesPedigreeFunction double, Age long")
    out = files.to_frame(df)
    assert out.schema == roles.SCORING_SCHEMA
    with pytest.raises(ValueError, match="lack fields"):
        files.to_frame(df.drop("Age"))


def test_metrics_json_roundtrip(spark):
    m = spark.createDataFrame([("a", "roc_auc", 0.5), ("a", "accuracy", 0.75)], files.METRICS_SCHEMA)
    path = scratch_path(spark, "m")
    files.write_metrics_json(m, path)
    assert sorted(files.read_metrics_json(spark, path).collect()) == sorted(m.collect())
