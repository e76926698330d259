import itertools

import pytest
from pyspark.sql import functions as F

from riskwise.operators import evaluate as EV


def _brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    tot = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_exact_with_ties(spark):
    rows = [(0.1, 0), (0.4, 1), (0.4, 0), (0.35, 1), (0.8, 1), (0.8, 1), (0.2, 0), (0.5, 0), (0.9, 1),
            (0.4, 1), (0.05, 0), (0.6, 0)]
    df = spark.createDataFrame(rows, "p double, label int")
    got = EV.auc_exact(df).first()["roc_auc"]
    assert got == pytest.approx(round(_brute_auc(rows), 6))


def test_auc_grouped_and_one_class(spark):
    rows = [("a", 0.1, 0), ("a", 0.9, 1), ("a", 0.5, 0), ("b", 0.3, 1), ("b", 0.7, 1)]
    df = spark.createDataFrame(rows, "model string, p double, label int")
    got = {r["model"]: r["roc_auc"] for r in EV.auc_exact(df, group_cols=["model"]).collect()}
    assert got["a"] == 1.0
    assert got["b"] is None  # one class: AUC undefined


def test_metrics_match_stored_run(spark):
    # confusion of the stored winning model: TP 25, FP 8, FN 18, TN 72
    rows = [(1, 1)] * 25 + [(0, 1)] * 8 + [(1, 0)] * 18 + [(0, 0)] * 72
    df = spark.createDataFrame(rows, "label int, prediction int")
    m = EV.classification_metrics(df, digits=12).first()
    assert m["accuracy"] == pytest.approx(0.7886178861788617, abs=1e-12)
    assert m["f1_score"] == pytest.approx(0.7809282891590525, abs=1e-12)
    assert m["precision"] == pytest.approx(0.7851687607785169, abs=1e-12)
    assert m["recall"] == pytest.approx(m["accuracy"], abs=1e-12)  # weighted recall == accuracy


def test_roc_monotone_and_trapezoid(spark):
    import random
    rnd = random.Random(3)
    rows = [(round(rnd.random(), 3), rnd.randint(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "p double, label int")
    roc = EV.roc_curve(df, resolution=1e-3).orderBy(F.desc("threshold")).collect()
    tprs = [r["tpr"] for r in roc]
    fprs = [r["fpr"] for r in roc]
    assert tprs == sorted(tprs) and fprs == sorted(fprs)
    assert tprs[-1] == 1.0 and fprs[-1] == 1.0
    area = EV.trapezoid_auc(EV.roc_curve(df, resolution=1e-3)).first()[0]
    assert area == pytest.approx(_brute_auc(rows), abs=2e-6)


def test_leaderboard_first_wins_ties(spark):
    wide = spark.createDataFrame([("b", 0.8), ("a", 0.8), ("c", 0.7)], "model string, roc_auc double")
    board = {r["model"]: r["rank"] for r in EV.leaderboard(wide, {"a": 0, "b": 1, "c": 2}).collect()}
    assert board == {"a": 1, "b": 2, "c": 3}


def _reduced(rows):
    """Keep the first and last point and every one whose two steps differ (thresholds falling)."""
    steps = {}
    for s, y in rows:
        steps.setdefault(s, [0, 0])[1 - y] += 1
    order = sorted(steps, reverse=True)
    out, tp, fp = [], 0, 0
    for i, s in enumerate(order):
        tp, fp = tp + steps[s][0], fp + steps[s][1]
        if i in (0, len(order) - 1) or steps[s] != steps[order[i + 1]]:
            out.append((s, tp, fp))
    return out


@pytest.mark.parametrize("n,places", [(1, 2), (2, 2), (400, 1), (400, 3)])
def test_roc_points_without_collinear_ones(spark, n, places):
    import random
    rnd = random.Random(n + places)
    rows = [(round(rnd.random(), places), int(rnd.random() < 0.3)) for _ in range(n)]
    df = spark.createDataFrame(rows + [(None, 1), (float("nan"), 0), (0.5, None)], "p double, label int")
    got = EV.roc_points(df, reduce=True)
    assert sorted(((r["threshold"], r["tp"], r["fp"]) for r in got.collect()), reverse=True) == _reduced(rows)
    full, less = EV.trapezoid_auc(EV.roc_points(df)).first()[0], EV.trapezoid_auc(got).first()[0]
    assert full == less and (n < 3 or got.count() < EV.roc_points(df).count() or places == 1)


def test_roc_reduction_of_a_straight_run_across_buckets(spark):
    # 5,000 scores of one negative each, then 5,000 of one positive each: the corner and the ends are left
    df = spark.range(10000).selectExpr("id / 10000D AS p", "cast(id >= 5000 as int) AS label")
    got = sorted((r["threshold"], r["tp"], r["fp"]) for r in EV.roc_points(df, reduce=True).collect())
    assert got == [(0.0, 5000, 5000), (0.5, 5000, 0), (0.9999, 1, 0)]
    assert EV.roc_points(df.where("p < 0"), reduce=True).count() == 0


def test_previous_values_by_group(spark):
    from riskwise.operators.ordered import running_totals
    df = spark.range(300).selectExpr("id % 3 AS g", "cast(id AS double) AS x", "id * 10 AS v", "if(id % 5 = 0, null, id) AS w")
    got = {(r["g"], r["x"]): (r["prev_v"], r["prev_w"], r["before_v"])
           for r in running_totals(df, "x", ["v"], ["g"], buckets=40, previous=["v", "w"]).collect()}
    for i in range(300):
        p = i - 3
        want = (None, None) if p < 0 else (p * 10, None if p % 5 == 0 else p)
        assert got[(i % 3, float(i))] == (*want, sum(j * 10 for j in range(i % 3, i, 3)))


def test_one_table_of_counts_gives_metrics_and_auc(spark):
    import random
    rnd = random.Random(8)
    rows = [(rnd.choice("ab"), round(rnd.random(), 2), rnd.randint(0, 1), rnd.choice([0, 1, None])) for _ in range(600)]
    rows += [("a", None, 1, 1), ("a", float("nan"), 0, 1), ("c", 0.5, 1, 1)]
    df = spark.createDataFrame(rows, "model string, p double, label int, prediction int")
    counts = EV.score_counts(df, group_cols=["model"])
    key = lambda d: sorted((tuple(r) for r in d.collect()), key=repr)
    assert key(EV.metrics_of_counts(counts, ["model"])) == key(EV.classification_metrics(df, group_cols=["model"]))
    assert key(EV.auc_of_counts(counts, ["model"])) == key(EV.auc_exact(df, group_cols=["model"]))
    assert counts.agg(F.sum(F.col("pos") + F.col("neg") + F.col("odd"))).first()[0] == len(rows)
    plan = EV.metric_table(df)._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan      # nothing reads the scored rows again
    bad = spark.createDataFrame([(0.1, 2, 1), (0.2, 1, 1)], "p double, label int, prediction int").withColumn("model", F.lit("m"))
    with pytest.raises(Exception, match="label other than 0 and 1"):
        EV.metric_table(bad).collect()


def test_roc_curve_rejects_scores_out_of_range(spark):
    df = spark.createDataFrame([(0.1, 0), (1.0, 1), (0.0, 1)], "p double, label int")
    assert EV.roc_curve(df).count() == 3
    for p in (-1e-9, 1.00001, 7.0):
        with pytest.raises(Exception, match="0..1"):
            EV.roc_curve(df.unionByName(spark.createDataFrame([(p, 1)], "p double, label int"))).collect()
