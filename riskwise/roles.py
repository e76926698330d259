"""Table roles and fixed parameter values.

A *role* tells the operators which columns are features, which of them use zero
as a missing-value marker, how the binary label is derived and which fixed
scoring weights apply.  The clinical role reproduces the measurement table of the
original application; the other roles map the same analysis onto the test tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Role:
    """Column roles of one measurement table."""

    features: tuple[str, ...]
    zero_missing: tuple[str, ...]
    label_sql: str  # SQL boolean/int expression giving the 0/1 label
    key: tuple[str, ...] = ()
    weights: tuple[float, ...] = ()
    intercept: float = 0.0
    hist_width: dict = field(default_factory=dict)
    clip: dict = field(default_factory=dict)

    def label(self) -> Column:
        return F.expr(f"CAST(({self.label_sql}) AS INT)")


# ---------------------------------------------------------------------------
# Fixed values of the clinical application (must equal the original for the
# same results): column names and order, the columns where 0 means "missing",
# the scoring-record types, feed clip bounds, guidance thresholds and texts,
# risk-band edges, outcome labels.
# ---------------------------------------------------------------------------
CLINICAL_FEATURES = (
    "Pregnancies", "Glucose", "BloodPressure", "SkinThickness",
    "Insulin", "BMI", "DiabetesPedigreeFunction", "Age",
)
CLINICAL_ZERO_MISSING = ("Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI")
CLINICAL_LABEL = "Outcome"

CLINICAL_SCHEMA = T.StructType(
    [T.StructField("Pregnancies", T.IntegerType(), True),
     T.StructField("Glucose", T.IntegerType(), True),
     T.StructField("BloodPressure", T.IntegerType(), True),
     T.StructField("SkinThickness", T.IntegerType(), True),
     T.StructField("Insulin", T.IntegerType(), True),
     T.StructField("BMI", T.DoubleType(), True),
     T.StructField("DiabetesPedigreeFunction", T.DoubleType(), True),
     T.StructField("Age", T.IntegerType(), True),
     T.StructField("Outcome", T.IntegerType(), True)]
)

SCORING_SCHEMA = T.StructType(
    [T.StructField("Pregnancies", T.IntegerType(), True),
     T.StructField("Glucose", T.DoubleType(), True),
     T.StructField("BloodPressure", T.DoubleType(), True),
     T.StructField("SkinThickness", T.DoubleType(), True),
     T.StructField("Insulin", T.DoubleType(), True),
     T.StructField("BMI", T.DoubleType(), True),
     T.StructField("DiabetesPedigreeFunction", T.DoubleType(), True),
     T.StructField("Age", T.IntegerType(), True)]
)

CLINICAL_CLIP = {
    "Glucose": (40.0, 250.0),
    "BMI": (15.0, 60.0),
    "BloodPressure": (40.0, 140.0),
    "SkinThickness": (0.0, 60.0),
    "Insulin": (0.0, 600.0),
    "DiabetesPedigreeFunction": (0.08, 2.5),
}

# Guidance rules, in display order: (column, threshold, text).  A record gets every
# rule whose value is strictly above the threshold; with none it gets the default.
CLINICAL_GUIDANCE = (
    ("Glucose", 140.0,
     "- **Glucose Control**: Plasma glucose is high (>140 mg/dL). Reduce simple carbohydrate "
     "and sugar intake. Daily glycemic monitoring is advised."),
    ("BMI", 25.0,
     "- **Weight Optimization**: BMI is in the overweight/obese range ({value:.1f}). Aiming for a "
     "5-10% reduction in weight through regular cardio and caloric control can reverse risk "
     "factor trends."),
    ("BloodPressure", 80.0,
     "- **Hypertension Management**: Diastolic BP is elevated (>80 mm Hg). Adopt a low-sodium "
     "DASH diet and monitor cardiovascular metrics."),
    ("Age", 45.0,
     "- **Age factor**: Patient is in the >45 age bracket. Annual screening is recommended due "
     "to increased metabolic resistance."),
)
CLINICAL_GUIDANCE_DEFAULT = (
    "- Excellent indicators! Keep up the balanced nutritional choices and active exercise routine."
)

# Report lines, in display order: (column, name, format, unit).
CLINICAL_REPORT = (
    ("Pregnancies", "Pregnancies", "%d", ""),
    ("Glucose", "Plasma Glucose", "%.1f", "mg/dL"),
    ("BloodPressure", "Diastolic Blood Pressure", "%.1f", "mm Hg"),
    ("SkinThickness", "Triceps Skin Fold", "%.1f", "mm"),
    ("Insulin", "2-Hour Serum Insulin", "%.1f", "mu U/ml"),
    ("BMI", "Body Mass Index (BMI)", "%.1f", "kg/m^2"),
    ("DiabetesPedigreeFunction", "Diabetes Pedigree Function", "%.3f", ""),
    ("Age", "Age", "%d", "Years"),
)

# Risk bands on the risk percentage: [0, 35) low, [35, 70) moderate, [70, 100] high;
# alert line at 70.
BAND_EDGES = (35.0, 70.0)
BAND_NAMES = ("low", "moderate", "high")
ALERT_PCT = 70.0

OUTCOME_WORDS = ("Non-Diabetic", "Diabetic")
DIAGNOSIS_WORDS = ("NEGATIVE", "POSITIVE")
FEED_DIAGNOSIS = ("NEGATIVE (Healthy)", "POSITIVE (Diabetic)")
FEED_HISTORY = 20
DECISION_THRESHOLD = 0.5

# ---------------------------------------------------------------------------
# Test-table roles
# ---------------------------------------------------------------------------
LINEITEM = Role(
    features=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    zero_missing=("l_discount", "l_tax"),
    label_sql="l_returnflag = 'R'",
    key=("l_orderkey", "l_linenumber"),
    weights=(0.9, 0.5, -0.3, 0.2),
    intercept=-0.2,
    hist_width={"l_quantity": 5.0, "l_extendedprice": 5000.0, "l_discount": 0.01, "l_tax": 0.01},
    clip={"l_quantity": (1.0, 45.0), "l_extendedprice": (1000.0, 90000.0),
          "l_discount": (0.0, 0.08), "l_tax": (0.0, 0.06)},
)

# Fixed scorers compared by the evaluation queries: (name, weights on the z-scored
# features, intercept).  The first one is the role's linear model.
LINEITEM_SCORERS = (
    ("linear", (0.9, 0.5, -0.3, 0.2), -0.2),
    ("quantity", (1.0, 0.0, 0.0, 0.0), 0.0),
    ("price", (0.0, 1.0, 0.0, 0.0), 0.0),
    ("discount", (0.0, 0.0, 1.0, 0.0), 0.0),
    ("tax", (0.0, 0.0, 0.0, 1.0), 0.0),
)

# Guidance rules for the lineitem role (same shape as the clinical rules).
LINEITEM_GUIDANCE = (
    ("l_quantity", 40.0, "- Quantity is high (>40). Review bulk terms."),
    ("l_extendedprice", 50000.0, "- Extended price is high (>50000). Check credit exposure."),
    ("l_discount", 0.08, "- Discount is deep (>0.08). Confirm approval."),
    ("l_tax", 0.06, "- Tax rate is high (>0.06). Verify jurisdiction."),
)
LINEITEM_GUIDANCE_DEFAULT = "- No flags raised."

# Feed role on the events table: one feed per event_type, ordered by event time.
FEED_KEY = "event_type"
FEED_TIME = "ts"
FEED_ID = "event_id"
FEED_FEATURES = ("value", "k")
FEED_WEIGHTS = (1.1, 0.4)
FEED_INTERCEPT = -0.3
FEED_CLIP = {"value": (0.0, 250.0), "k": (0.0, 100.0)}

# Labelled learning set: documents joined with labels.
DOC_FEATURES = ("n_chars", "n_words", "n_lines", "n_digits", "n_punct", "n_upper")
DOC_LABEL = "quality"
