"""riskwise — Spark-native tabular risk scoring and model evaluation.

Every operator is a ``DataFrame -> DataFrame`` function (or a small fit/transform
pair whose fitted state is a handful of scalars).  Column names are parameters, so
the same code runs on the clinical measurement schema and on any other table.
The library never creates a session, never sets a master and never pulls
data-sized results to the driver.
"""

__version__ = "0.1.0"
