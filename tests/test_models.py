"""Published models, rule tables, tree contributions, wide correlations."""

import itertools
import math
import threading

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskwise.functions import columns as C
from riskwise.operators import explain, stats
from riskwise.plans import learners as L
from riskwise.session import scratch_path

FEATURES = [f"f{i}" for i in range(6)]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 6)).round(2)
    y = ((x[:, 0] > 0) & (x[:, 1] + x[:, 2] > 0.2) | (x[:, 3] > 1)).astype(int)
    return spark.createDataFrame([(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))],
                                 "id int, " + ", ".join(f"{f} double" for f in FEATURES) + ", label int").cache()


def _pipeline(clf):
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), clf])


def _known(leaves, x, known):
    """Score when only the features in ``known`` are known, straight from the definition."""
    total = 0.0
    for leaf in leaves:
        p = leaf.value
        for f, lo, hi, share in zip(leaf.features, leaf.above, leaf.upto, leaf.share):
            p *= float(lo < x[f] <= hi) if f in known else share
        total += p
    return total


TREES = {"boosted": lambda: GBTClassifier(labelCol="label", maxIter=4, maxDepth=4, seed=1),
         "tree": lambda: DecisionTreeClassifier(labelCol="label", maxDepth=5),
         "forest": lambda: RandomForestClassifier(labelCol="label", numTrees=3, maxDepth=4, seed=2)}


@pytest.mark.parametrize("kind", TREES)
def test_tree_contributions_equal_all_subsets(rows, kind):
    clf = TREES[kind]()
    model = _pipeline(clf).fit(rows)
    leaves = explain.tree_leaves(model.stages[-1])
    out = explain.tree_contributions(model, rows, FEATURES, ["id"]).collect()
    score = vector_to_array("rawPrediction" if isinstance(clf, GBTClassifier) else "probability")[1]
    own = {r["id"]: r["s"] for r in model.transform(rows).select("id", score.alias("s")).collect()}
    terms = {}
    for r in out:
        terms.setdefault(r["id"], {})[r["feature"]] = r["contribution"]
    expected = out[0]["expected"]
    assert len(out) == 400 * 6 and all(abs(sum(t.values()) + expected - own[i]) < 1e-9 for i, t in terms.items())
    for r in rows.where("id < 12").collect():
        x = [r[f] for f in FEATURES]
        for i, f in enumerate(FEATURES):
            rest, want = [j for j in range(6) if j != i], 0.0
            for s in range(6):
                w = math.factorial(s) * math.factorial(5 - s) / math.factorial(6)
                want += sum(w * (_known(leaves, x, {*k, i}) - _known(leaves, x, set(k))) for k in itertools.combinations(rest, s))
            assert abs(terms[r["id"]][f] - want) < 1e-9
        assert abs(_known(leaves, x, set()) - expected) < 1e-9


def test_only_trees_are_explained(rows):
    with pytest.raises(ValueError, match="not a tree"):
        explain.tree_contributions(_pipeline(LogisticRegression(maxIter=1)).fit(rows), rows, FEATURES)
    flat = explain.tree_contributions(_pipeline(DecisionTreeClassifier(labelCol="label", maxDepth=0)).fit(rows), rows, FEATURES, ["id"])
    assert flat.agg(F.max(F.abs("contribution"))).first()[0] == 0.0       # a single leaf
    assert explain.tree_contributions(_pipeline(GBTClassifier(labelCol="label", maxIter=1)).fit(rows), rows.limit(0), FEATURES).count() == 0


def test_readers_of_a_published_model_get_the_old_or_the_new_one(spark, rows):
    path = scratch_path(spark, "published")
    with pytest.raises(FileNotFoundError, match="training first"):
        L.load_published(rows, path)
    scaler = lambda d: Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="x"),
                                        StandardScaler(inputCol="x", outputCol="z", withMean=True)]).fit(d)
    models = [scaler(rows), scaler(rows.where("id < 50")), scaler(rows.where("id < 99"))]
    versions = [L.publish_model(models[0], path, rows, FEATURES)]
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            version, contract = L.published(spark, path)
            seen.append((version, len(contract), L.PipelineModel.load(version).stages[-1].mean[0]))

    reader = threading.Thread(target=read)
    reader.start()
    versions += [L.publish_model(m, path, rows, FEATURES) for m in models[1:]]
    stop.set()
    reader.join()
    means = dict(zip(versions, (m.stages[-1].mean[0] for m in models)))
    assert seen and all(n == 6 and means[v] == mean for v, n, mean in seen)     # whole, and one of the three
    assert L.published(spark, path)[0] == versions[-1]


def test_feature_contract_names_what_differs(spark, rows):
    path = scratch_path(spark, "contract")
    L.publish_model(_pipeline(LogisticRegression(maxIter=1)).fit(rows), path, rows, FEATURES)
    assert L.load_published(rows, path).transform(rows).count() == 400
    assert L.load_published(rows.select(*reversed(rows.columns)), path) is not None       # order of columns does not matter
    with pytest.raises(L.FeatureContractError, match="f1 is int, not double; f3 is missing"):
        L.load_published(rows.withColumn("f1", F.col("f1").cast("int")).drop("f3"), path)


def _texts(df, rules, default="none"):
    t = df.sparkSession.createDataFrame(rules, C.RULE_SCHEMA)
    return [r["t"] for r in df.select("id", C.rule_lines(df, t, default).alias("t")).orderBy("id").collect()]


def test_rules_from_a_table(spark):
    df = spark.createDataFrame([(0, 5.0, 1), (1, 15.0, 2), (2, 20.0, None), (3, float("nan"), 3), (4, None, None)], "id int, a double, b int")
    rules = [(2, "b", 1.0, None, "b high"), (1, "a", 10.0, 20.0, "a {value:.1f}"), (1, "a", 10.0, 15.0, "a small"), (0, "a", None, 5.0, "a low")]
    assert _texts(df, rules) == ["a low", "a small\na 15.0\nb high", "a 20.0", "b high", "none"]
    assert _texts(df, []) == ["none"] * 5 and _texts(df, [(0, "a", 99.0, None, "x")]) == ["none"] * 5
    with pytest.raises(ValueError, match="lack: .'zz'"):
        _texts(df, [(0, "zz", 1.0, None, "x")])


def test_wide_correlations_in_one_scan(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 30))
    x[:, 1] = x[:, 0] * 2 + rng.normal(size=200) * 0.1
    x[:, 5] = 3.0
    data = [[None if rng.random() < 0.1 else float(v) for v in r] for r in x]
    for r in data:
        r[7] = None
    cols = [f"c{i}" for i in range(30)]
    df = spark.createDataFrame([tuple(r) for r in data], ", ".join(f"{c} double" for c in cols))
    out = stats.corr_matrix(df, cols)
    got = {(r["col_a"], r["col_b"]): r["r"] for r in out.collect()}
    assert len(got) == 900
    for i, j in itertools.product(range(30), repeat=2):
        both = [(r[i], r[j]) for r in data if r[i] is not None and r[j] is not None]
        if 5 in (i, j) or 7 in (i, j):
            assert got[cols[i], cols[j]] is None
        else:
            assert abs(got[cols[i], cols[j]] - np.corrcoef(np.array(both).T)[0, 1]) < 2e-6
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 2      # the rows, and the names
    assert {r["r"] for r in stats.corr_matrix(df.limit(0), cols[:2]).collect()} == {None}


def test_fold_preparation_from_one_scan(spark):
    rng = np.random.default_rng(5)
    n = 3000
    data = [(i, None if rng.random() < 0.2 else float(rng.gamma(2.0)), float(rng.normal(100, 5)), 7.0, int(rng.random() < 0.4)) for i in range(n)]
    df = spark.createDataFrame(data, "id int, a double, b double, c double, label int")
    cols = ["a", "b", "c"]
    with L.prepare_folds(df, cols, ["a"], "label", ["id"], 3) as folds:
        fold = {r["id"]: r["__fold"] for r in folds.data.select("id", "__fold").collect()}
        assert len(folds.frames) == 3 and sum(v.count() for _, v in folds.frames) == n
        for f, (tr, va) in enumerate(folds.frames):
            side = [r for r in data if fold[r[0]] != f]
            a = np.array([r[1] for r in side if r[1] is not None])
            fill = folds.surrogates[f]["a"]
            assert abs((a < fill).mean() - 0.5) < 0.002 and tr.count() == len(side)
            x = np.array([[fill if r[1] is None else r[1], r[2], r[3]] for r in side])
            z = (x - x.mean(axis=0)) / np.where(x.std(axis=0, ddof=1) > 0, x.std(axis=0, ddof=1), 1)
            got = np.array([r["features"].toArray() for r in tr.collect()])
            assert np.allclose(np.sort(got, axis=0), np.sort(z, axis=0), atol=1e-9)
        shared = L.tune(df, "LogisticRegression", {"regParam": [0.01]}, cols, ["a"], "label", ["id"], prepared=folds)
    alone = L.tune(df, "LogisticRegression", {"regParam": [0.01]}, cols, ["a"], "label", ["id"])
    assert shared.cv_auc == pytest.approx(alone.cv_auc, abs=1e-9)
    assert [type(s).__name__ for s in shared.model.stages] == ["ImputerModel", "VectorAssembler", "StandardScalerModel", "LogisticRegressionModel"]
    assert shared.model.transform(df).count() == n
