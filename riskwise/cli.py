"""Command line: ``python -m riskwise.cli train CSV OUT_DIR`` / ``score MODEL_DIR CSV OUT``.

Uses the session from ``SparkSession.builder.getOrCreate()`` (spark-submit
settings apply); only when no master is configured does it start a local one.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from riskwise import roles
from riskwise.operators import quarantine
from riskwise.plans import workflow
from riskwise.sources import files


def _session() -> SparkSession:
    b = SparkSession.builder.appName("riskwise")
    try:
        from pyspark import SparkConf
        if not SparkConf().contains("spark.master"):
            b = b.master("local[*]").config("spark.ui.enabled", "false")
    except Exception:  # noqa: BLE001
        pass
    spark = b.getOrCreate()
    from riskwise.session import shared_dir
    shared_dir(spark)
    return spark


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="riskwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train", help="train, tune and select on a measurement CSV")
    t.add_argument("csv")
    t.add_argument("out_dir")
    t.add_argument("--grid", choices=["full", "walkthrough"], default="full")
    s = sub.add_parser("score", help="score records with a saved pipeline")
    s.add_argument("model_dir")
    s.add_argument("csv")
    s.add_argument("out")
    s.add_argument("--rejects", help="folder for records that cannot be scored (default: OUT-rejects)")
    a = ap.parse_args(argv)
    spark = _session()
    if a.cmd == "train":
        from riskwise.plans import learners as L
        df = files.read_csv(spark, a.csv, roles.CLINICAL_SCHEMA)
        grid = L.FULL_GRID if a.grid == "full" else L.WALKTHROUGH_GRID
        print(json.dumps(workflow.train_and_select(spark, df, a.out_dir, grid=grid)))
    else:
        recs = files.read_csv_records(spark, a.csv, roles.SCORING_SCHEMA)
        rejects = a.rejects or a.out.rstrip("/") + "-rejects"
        good, bad = quarantine.split(recs, workflow.SCORING_CHECK)
        bad.write.mode("overwrite").parquet(rejects)
        workflow.score_records(good, a.model_dir).write.mode("overwrite").parquet(a.out)
        print(json.dumps({"scored": a.out, "rejects": rejects}))


if __name__ == "__main__":
    main()
