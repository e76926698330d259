"""The stored winning model of the clinical application, as a linear form on raw
values with median fills (recovered from its stored predictions), must reproduce
the stored probabilities through our scoring functions."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwise import roles
from riskwise.functions import columns as C

SLOPES = {"Pregnancies": 0.09950688655939, "Glucose": 0.03141609066135, "BloodPressure": 0.0,
          "SkinThickness": 0.0, "Insulin": -7.530401072644e-05, "BMI": 0.07872248857574,
          "DiabetesPedigreeFunction": 0.77598868768902, "Age": 0.01229855291}
CONST = -8.343150290587669
FILLS = {"Glucose": 118.0, "Insulin": 125.0, "BMI": 32.0, "BloodPressure": 0.0, "SkinThickness": 0.0}

# (record with 0 = missing, stored probability)
ROWS = [
    ((0, 73.0, 0.0, 0.0, 0.0, 21.1, 0.342, 25), 0.021346450797624983),
    ((0, 84.0, 82.0, 31.0, 125.0, 38.2, 0.233, 23), 0.09597749383076837),
    ((0, 91.0, 68.0, 32.0, 210.0, 39.9, 0.381, 25), 0.1472974109213171),
    ((0, 94.0, 0.0, 0.0, 0.0, 0.0, 0.256, 25), 0.08516024448191994),
    ((0, 98.0, 82.0, 15.0, 84.0, 25.2, 0.299, 22), 0.05817830529712975),
]


def test_golden_probabilities(spark):
    schema = T.StructType(roles.SCORING_SCHEMA.fields + [T.StructField("expected", T.DoubleType())])
    df = spark.createDataFrame([r + (p,) for r, p in ROWS], schema)
    clean = C.zeros_to_null(df, roles.CLINICAL_ZERO_MISSING)
    filled = clean.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in FILLS.items()})
    scored = filled.withColumn("p", C.sigmoid(C.linear_margin(list(SLOPES), list(SLOPES.values()), CONST)))
    for r in scored.collect():
        assert r["p"] == pytest.approx(r["expected"], abs=1e-9)
        assert (r["p"] > roles.DECISION_THRESHOLD) == (r["expected"] > 0.5)


def test_guidance_and_bands(spark):
    df = spark.createDataFrame([(150.0, 30.0, 85.0, 50), (100.0, 22.0, 70.0, 30)],
                               "Glucose double, BMI double, BloodPressure double, Age int")
    rows = df.select(C.guidance_lines(roles.CLINICAL_GUIDANCE, roles.CLINICAL_GUIDANCE_DEFAULT).alias("g"),
                     C.guidance_text(roles.CLINICAL_GUIDANCE, roles.CLINICAL_GUIDANCE_DEFAULT).alias("t")).collect()
    assert len(rows[0]["g"]) == 4 and "(30.0)" in rows[0]["g"][1]
    assert rows[1]["g"] == [roles.CLINICAL_GUIDANCE_DEFAULT]
    assert rows[0]["t"] == "\n".join(rows[0]["g"])
    bands = spark.createDataFrame([(10.0,), (35.0,), (69.9,), (70.0,), (None,)], "x double") \
        .select(C.risk_band("x").alias("b")).collect()
    assert [b["b"] for b in bands] == ["low", "moderate", "moderate", "high", None]
