"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

The queries map the clinical analysis onto the test tables (roles in
``riskwise.roles``) and always read whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwise import roles
from riskwise.functions import columns as C
from riskwise.operators import evaluate as EV
from riskwise.operators import feed as FD
from riskwise.operators import quality, quarantine, split, stats
from riskwise.operators.prep import fit_impute, fit_scale
from riskwise.operators.score import LinearRisk, band_summary
from riskwise.session import scratch_path, table

LI = roles.LINEITEM


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def q_risk_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step 1: zeros -> NULL, exact median fill, z-score, linear score, band counts."""
    li = lineitem(spark, sf_dir)
    model = LinearRisk.for_role(li, LI)
    return band_summary(model.transform(li.select(*LI.features)))


def li_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).withColumn("label", LI.label())


def li_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with zeros -> NULL in the zero-missing features and the label."""
    return C.zeros_to_null(li_labeled(spark, sf_dir), LI.zero_missing)


# ---- step 2: quality and EDA ------------------------------------------------
def q_missing_profile(spark, sf_dir):
    return quality.missing_profile(lineitem(spark, sf_dir), LI.features)


def q_kpis(spark, sf_dir):
    return quality.kpis(li_labeled(spark, sf_dir), "label", ["l_quantity", "l_discount"], LI.zero_missing)


def q_label_counts(spark, sf_dir):
    return quality.label_counts(li_labeled(spark, sf_dir), "label")


def q_group_means(spark, sf_dir):
    return stats.group_means(li_clean(spark, sf_dir), "label", LI.features)


def q_describe(spark, sf_dir):
    return stats.describe(li_clean(spark, sf_dir), LI.features)


def q_histogram_by_label(spark, sf_dir):
    return stats.histogram_by_label(li_labeled(spark, sf_dir), LI.hist_width, "label")


def q_corr_matrix(spark, sf_dir):
    return stats.corr_matrix(li_labeled(spark, sf_dir), list(LI.features) + ["label"])


LI_ALL = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def q_first_rows(spark, sf_dir):
    return quality.first_rows(lineitem(spark, sf_dir), LI_ALL, 5)


def q_clip_bounds(spark, sf_dir):
    li = lineitem(spark, sf_dir).select(*LI.key, *LI.features)
    return C.clip_columns(li, LI.clip)


# ---- step 3: preparation and splits -----------------------------------------
def q_median_surrogates(spark, sf_dir):
    clean = C.zeros_to_null(lineitem(spark, sf_dir), LI.zero_missing)
    return fit_impute(clean, LI.zero_missing, "median").table(spark)


def q_imputer_ml_surrogates(spark, sf_dir):
    """A9, Spark ML form: ``Imputer(strategy='median')`` surrogates (approximate,
    relativeError 0.001), next to the exact ``median_surrogates``."""
    from pyspark.ml.feature import Imputer
    clean = C.to_double(C.zeros_to_null(lineitem(spark, sf_dir).select(*LI.zero_missing), LI.zero_missing),
                        LI.zero_missing)
    model = Imputer(inputCols=list(LI.zero_missing), outputCols=[f"{c}_imputed" for c in LI.zero_missing],
                    strategy="median").fit(clean)
    return model.surrogateDF.unpivot([], list(LI.zero_missing), "column", "surrogate")


def q_impute_median(spark, sf_dir):
    clean = C.zeros_to_null(lineitem(spark, sf_dir).select(*LI.key, *LI.zero_missing), LI.zero_missing)
    return fit_impute(clean, LI.zero_missing, "median").transform(clean)


def _standardize(spark, sf_dir, ddof):
    clean = C.zeros_to_null(lineitem(spark, sf_dir).select(*LI.key, *LI.features), LI.zero_missing)
    filled = fit_impute(clean, LI.zero_missing, "median").transform(clean)
    z = fit_scale(filled, LI.features, ddof=ddof, suffix="__z").transform(filled)
    return z.select(*LI.key, *[F.round(f"{c}__z", 6).alias(f"z_{c}") for c in LI.features])


def q_standardize_samp(spark, sf_dir):
    return _standardize(spark, sf_dir, 1)


def q_standardize_pop(spark, sf_dir):
    return _standardize(spark, sf_dir, 0)


def _split_counts(df, by):
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("n_pos"))


def q_hash_split(spark, sf_dir):
    return _split_counts(split.hash_split(li_labeled(spark, sf_dir), ["l_orderkey"], 20), "split")


def q_fold_assign(spark, sf_dir):
    return _split_counts(split.fold_assign(li_labeled(spark, sf_dir), ["l_orderkey"], 3), "fold")


def q_stratified_split(spark, sf_dir):
    s = split.stratified_split(li_labeled(spark, sf_dir), "label", ["l_orderkey"], LI_ALL, 0.2)
    return s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


# ---- step 4: scoring and rules -----------------------------------------------
def li_scored(spark, sf_dir, keep_z=False):
    li = li_labeled(spark, sf_dir)
    return LinearRisk.for_role(li, LI).transform(li, keep_z=keep_z)


def q_linear_score(spark, sf_dir):
    return li_scored(spark, sf_dir).select(*LI.key, "label", F.round("p", 6).alias("p"),
                                           "prediction", "risk_pct")


def q_score_labels(spark, sf_dir):
    s = li_scored(spark, sf_dir)
    return s.select(*LI.key,
                    C.outcome_word("prediction", roles.DIAGNOSIS_WORDS).alias("diagnosis"),
                    C.risk_band(F.col("p") * 100.0).alias("band"),
                    C.pct_text("p", 2).alias("confidence"),
                    (F.col("risk_pct") >= roles.ALERT_PCT).alias("alert"))


def q_margin_to_probability(spark, sf_dir):
    from pyspark.ml.functions import array_to_vector
    s = li_scored(spark, sf_dir).withColumn(
        "rawPrediction", array_to_vector(F.array(-F.col("margin"), F.col("margin"))))
    return s.select(*LI.key, F.round(C.margin_to_probability("rawPrediction"), 6).alias("p_margin"))


def q_contributions(spark, sf_dir):
    li = lineitem(spark, sf_dir)
    c = LinearRisk.for_role(li, LI).contributions(li, LI.key)
    return c.select(*LI.key, "feature", F.round("contribution", 6).alias("contribution"))


def q_guidance_rules(spark, sf_dir):
    li = lineitem(spark, sf_dir)
    return li.select(*LI.key, C.guidance_text(roles.LINEITEM_GUIDANCE, roles.LINEITEM_GUIDANCE_DEFAULT)
                     .alias("guidance"))


def q_guidance_table(spark, sf_dir):
    """The fixed rules as a table, and rules with an upper bound that overlap them."""
    more = (("l_quantity", 10.0, 20.0, "- Quantity is moderate ({value:.1f})."), ("l_quantity", 15.0, 45.0, "- Quantity is above 15 and up to 45."),
            ("l_tax", None, 0.0, "- No tax."))
    rules = [(i, c, t, None, text) for i, (c, t, text) in enumerate(roles.LINEITEM_GUIDANCE)]
    rules += [(i + len(rules), *r) for i, r in enumerate(more)]
    li = lineitem(spark, sf_dir).select(*LI.key, *LI.features)
    return li.select(*LI.key, C.rule_lines(li, spark.createDataFrame(rules, C.RULE_SCHEMA), roles.LINEITEM_GUIDANCE_DEFAULT)
                     .alias("guidance"))


def q_report_text(spark, sf_dir):
    """P15 on the values as entered: the score uses the filled ones, the report does not print them."""
    li = lineitem(spark, sf_dir).select(*LI.key, *LI.features)
    s = LinearRisk.for_role(li, LI).transform(li.withColumn("entered", F.struct(*LI.features)))
    report = C.report_text([(c, c, "%.2f", "") for c in LI.features], roles.LINEITEM_GUIDANCE,
                           roles.LINEITEM_GUIDANCE_DEFAULT, "prediction", "p", LI.zero_missing)
    return s.select(*LI.key, "prediction", "p", "entered.*").select(*LI.key, report.alias("report"))


# ---- step 5: evaluation on fixed scores ---------------------------------------
def li_scored_long(spark, sf_dir):
    """One row per (line, scorer): model, label, p, prediction."""
    li = li_labeled(spark, sf_dir)
    lr = LinearRisk.for_role(li, LI)
    z = lr.transform(li, keep_z=True)
    arr = F.array(*[F.struct(F.lit(name).alias("model"),
                             C.sigmoid(C.linear_margin(lr.zcols(), w, b)).alias("p"))
                    for name, w, b in roles.LINEITEM_SCORERS])
    return (z.select("label", F.inline(arr))
            .withColumn("prediction", (F.col("p") > roles.DECISION_THRESHOLD).cast("int")))


def q_confusion(spark, sf_dir):
    return EV.confusion(li_scored(spark, sf_dir))


def q_classification_metrics(spark, sf_dir):
    return EV.classification_metrics(li_scored(spark, sf_dir))


def q_roc_curve(spark, sf_dir):
    return EV.roc_curve(li_scored(spark, sf_dir))


def q_roc_points(spark, sf_dir):
    return EV.roc_points(li_scored(spark, sf_dir)).withColumn("threshold", F.round("threshold", 6))


def q_roc_reduced(spark, sf_dir):
    return EV.roc_points(li_scored(spark, sf_dir), reduce=True).withColumn("threshold", F.round("threshold", 6))


def q_roc_auc_trapezoid(spark, sf_dir):
    return EV.trapezoid_auc(EV.roc_curve(li_scored(spark, sf_dir)))


def q_auc_exact(spark, sf_dir):
    return EV.auc_exact(li_scored(spark, sf_dir))


def q_auc_binned(spark, sf_dir):
    """A13, Spark ML form: ``BinaryClassificationEvaluator`` (1,000 score bins by
    default), next to the exact ``auc_exact``."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    s = li_scored(spark, sf_dir).withColumn("rawPrediction", array_to_vector(F.array(-F.col("margin"),
                                                                                     F.col("margin"))))
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction").evaluate(s)
    return spark.createDataFrame([(float(auc),)], "roc_auc_binned double")


def q_metrics_unpivot(spark, sf_dir):
    return EV.metric_table(li_scored_long(spark, sf_dir))


def q_metrics_pivot(spark, sf_dir):
    return EV.metric_pivot(EV.metric_table(li_scored_long(spark, sf_dir)))


def q_leaderboard(spark, sf_dir):
    wide = EV.metric_pivot(EV.metric_table(li_scored_long(spark, sf_dir)))
    order = {name: i for i, (name, _, _) in enumerate(roles.LINEITEM_SCORERS)}
    return EV.leaderboard(wide, order)


def q_metric_labels(spark, sf_dir):
    """Display form of the metric table (``ROC-AUC``, fixed 4 decimals)."""
    t = EV.metric_table(li_scored_long(spark, sf_dir), digits=None)  # format full precision once
    return t.select("model", C.metric_label("metric").alias("metric_label"), C.fixed4("score").alias("score_text"))


def q_coef_rank(spark, sf_dir):
    z = li_scored(spark, sf_dir, keep_z=True)
    one = z.agg(*[F.round(F.regr_slope(F.col("label").cast("double"), F.col(f"{c}__z")), 6).alias(c)
                  for c in LI.features])
    coefs = one.unpivot([], list(LI.features), "feature", "weight")
    return EV.coef_rank(coefs)


# ---- step 7: feed (batch and streaming) -----------------------------------------
FEED_COLS = ("event_id", "feed_key", "tag", "clock", "value", "k", "risk_pct", "diagnosis")


def feed_scored(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return FD.FeedScorer.fit(ev).transform(ev).withColumnRenamed(roles.FEED_KEY, "feed_key")


def q_feed_score(spark, sf_dir):
    return feed_scored(spark, sf_dir).select(*FEED_COLS)


def q_last20_rate(spark, sf_dir):
    r = FD.rolling_rate(feed_scored(spark, sf_dir), "feed_key", roles.FEED_TIME, roles.FEED_ID, "prediction")
    return r.select("event_id", "feed_key", "n_window", "n_pos", "pos_rate")


def q_newest20(spark, sf_dir):
    nw = FD.newest_per_key(feed_scored(spark, sf_dir), "feed_key", roles.FEED_TIME, roles.FEED_ID)
    return nw.select("feed_key", "event_id", "position", "risk_pct", "diagnosis")


def q_timeline(spark, sf_dir):
    t = FD.timeline(feed_scored(spark, sf_dir), roles.FEED_TIME, roles.FEED_ID)
    return t.select("step", "event_id", "feed_key", "clock", "risk_pct")


def q_feed_kpis(spark, sf_dir):
    nw = FD.newest_per_key(feed_scored(spark, sf_dir), "feed_key", roles.FEED_TIME, roles.FEED_ID)
    return FD.feed_kpis(nw, "feed_key")


def _stream_setup(spark, sf_dir):
    from riskwise.streaming import feed as ST
    ev = table(spark, sf_dir, "events")
    return ST, FD.FeedScorer.fit(ev), ST.event_source(spark, f"{sf_dir.rstrip('/')}/events.parquet")


def q_stream_score(spark, sf_dir):
    ST, scorer, src = _stream_setup(spark, sf_dir)
    return spark.read.parquet(ST.score_stream(spark, src, scorer)).select(*FEED_COLS)


def q_quarantine_stream(spark, sf_dir):
    """Events with faults by id arrive in a stream; every one ends up scored or rejected with its reasons."""
    ST, scorer, src = _stream_setup(spark, sf_dir)
    fault = F.col("event_id") % 30
    bad = src.withColumns({
        "value": F.when(fault == 0, None).when(fault == 1, float("nan")).when(fault == 4, float("inf")).otherwise(F.col("value")),
        "props": F.when(fault.isin(2, 4), F.lit("no json")).otherwise(F.col("props")),
        "ts": F.when(fault == 3, None).otherwise(F.col("ts"))})
    rows = quarantine.read_checked(spark, ST.score_stream_checked(spark, bad, scorer))
    return rows.select("event_id", F.col(roles.FEED_KEY).alias("feed_key"), "accepted",
                       F.concat_ws("; ", "reasons").alias("reasons"), "risk_pct", "diagnosis", "clock")


def q_stream_last20(spark, sf_dir):
    ST, scorer, src = _stream_setup(spark, sf_dir)
    out = ST.read_last_n(spark, ST.last_n_stream(spark, src, scorer))
    return out.select("event_id", "feed_key", "n_window", "n_pos", "pos_rate")


def q_stream_trend(spark, sf_dir):
    ST, scorer, src = _stream_setup(spark, sf_dir)
    return ST.read_trend(spark, ST.trend_stream(spark, src, scorer))


# ---- step 6: learners on the labelled documents ----------------------------------
def docs_labelled(spark, sf_dir):
    from riskwise.functions.text import labelled_documents
    return labelled_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_doc_features(spark, sf_dir):
    return docs_labelled(spark, sf_dir).select("doc_id", "quality", *roles.DOC_FEATURES)


DOC_ZERO_MISSING = ("n_digits",)


def _doc_split(spark, sf_dir):
    from riskwise.plans import learners as L
    d = L.prepare(docs_labelled(spark, sf_dir), roles.DOC_FEATURES, DOC_ZERO_MISSING)
    d = split.hash_split(d, ["doc_id"], 20)
    return d.where("split = 'train'"), d.where("split = 'test'")


def _train_one(spark, sf_dir, name, grid_name="full"):
    from riskwise.plans import learners as L
    grid = (L.FULL_GRID if grid_name == "full" else L.WALKTHROUGH_GRID)[name]
    train, test = _doc_split(spark, sf_dir)
    res = L.tune(train, name, grid, roles.DOC_FEATURES, DOC_ZERO_MISSING, roles.DOC_LABEL, ["doc_id"])
    return res, test


def _train_query(name):
    def q(spark, sf_dir):
        from riskwise.plans import learners as L
        res, test = _train_one(spark, sf_dir, name)
        cv = spark.createDataFrame([(name, "cv_roc_auc", float(round(res.cv_auc, 6)))],
                                   "model string, metric string, score double")
        return L.test_metrics(res.model, test, name, roles.DOC_LABEL).unionByName(cv)
    q.__name__ = f"q_train_{name}"
    return q


def q_fit_accuracy(spark, sf_dir):
    """Accuracy on the fitted rows beside that on the held-out ones."""
    from riskwise.plans import learners as L
    train, test = _doc_split(spark, sf_dir)
    res, _ = _train_one(spark, sf_dir, "LogisticRegression", "walkthrough")
    return L.accuracy_by_side(res.model, train, test, "LogisticRegression", roles.DOC_LABEL)


def q_grid_cv(spark, sf_dir):
    res, _ = _train_one(spark, sf_dir, "LogisticRegression")
    rows = [("LogisticRegression", ", ".join(f"{k}={v}" for k, v in sorted(p.items())), float(round(a, 6)))
            for p, a in res.cv_table]
    return spark.createDataFrame(rows, "model string, params string, cv_roc_auc double")


def q_champion(spark, sf_dir):
    """A15 on the walkthrough grid: pick the model with the best mean CV ROC-AUC
    (first wins ties), then report its held-out metrics."""
    from riskwise.plans import learners as L
    train, test = _doc_split(spark, sf_dir)
    with L.prepare_folds(train, roles.DOC_FEATURES, DOC_ZERO_MISSING, roles.DOC_LABEL, ["doc_id"]) as folds:
        results = {name: L.tune(train, name, L.WALKTHROUGH_GRID[name], roles.DOC_FEATURES, DOC_ZERO_MISSING, roles.DOC_LABEL,
                                ["doc_id"], prepared=folds) for name in L.MODEL_ORDER if name in L.WALKTHROUGH_GRID}
    order = {n: i for i, n in enumerate(L.MODEL_ORDER)}
    cv = spark.createDataFrame([(n, float(r.cv_auc)) for n, r in results.items()], "model string, roc_auc double")
    board = EV.leaderboard(cv, order)
    best = board.where("champion").first()["model"]
    held = L.test_metrics(results[best].model, test, best, roles.DOC_LABEL)
    return board.withColumnRenamed("roc_auc", "cv_roc_auc").join(
        held.groupBy("model").pivot("metric", list(EV.METRICS)).agg(F.first("score")), "model", "left")


def q_save_load_score(spark, sf_dir):
    """S3 -> S4 -> M14 -> S6: save the tuned pipeline, load it back, score the
    held-out rows and write the predictions as a table."""
    from riskwise.plans import learners as L
    res, test = _train_one(spark, sf_dir, "LogisticRegression", "walkthrough")
    path = scratch_path(spark, "model")
    L.save_model(res.model, path)
    model = L.load_model(path)
    pred = L.predictions(model, test, roles.DOC_LABEL, ["doc_id"])
    return L.export_predictions(pred.withColumn("p", F.round("p", 6)), scratch_path(spark, "predictions"))


def q_lr_coefficients(spark, sf_dir):
    from riskwise.plans import learners as L
    res, _ = _train_one(spark, sf_dir, "LogisticRegression", "walkthrough")
    return EV.coef_rank(L.coefficients(res.model, roles.DOC_FEATURES).where("feature <> '(intercept)'"))


def q_learner_checks(spark, sf_dir):
    """One fitted pipeline per family, and checks computed from its own rows."""
    from riskwise.plans import learners as L
    train, test = _doc_split(spark, sf_dir)
    rows = []
    for name in L.MODEL_ORDER:
        found = L.check_learner(train, test, name, roles.DOC_FEATURES, DOC_ZERO_MISSING, roles.DOC_LABEL, "doc_id",
                                scratch_path(spark, f"checked-{name}"))
        rows.append((name, len(L.param_maps(L.make_classifier(name, roles.DOC_LABEL), L.FULL_GRID[name])), *found))
    return spark.createDataFrame(rows, "model string, grid_points int, n_train long, n_test long, n_test_pos long, "
                                       "surrogates_ok boolean, scaler_ok boolean, prediction_follows_score boolean, "
                                       "reload_agrees boolean, metrics_agree boolean")


def q_tuning_checks(spark, sf_dir):
    """Rows of every fold, the winner, and the logistic regression's gradient at its weights."""
    from riskwise.plans import learners as L
    train, _ = _doc_split(spark, sf_dir)
    res = L.tune(train, "LogisticRegression", L.WALKTHROUGH_GRID["LogisticRegression"], roles.DOC_FEATURES,
                 DOC_ZERO_MISSING, roles.DOC_LABEL, ["doc_id"])
    ok = L.check_tuning(res, train, roles.DOC_FEATURES, roles.DOC_LABEL)
    folds = split.fold_assign(train, ["doc_id"], 3).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(roles.DOC_LABEL) == 1).alias("n_pos"))
    return folds.select("fold", "n", "n_pos", F.lit(len(res.cv_table)).alias("grid_points"),
                        *[F.lit(bool(v)).alias(k) for k, v in ok.items()])


def q_tree_contributions(spark, sf_dir):
    """Contributions of boosted trees on every document; with what is expected they make up the model's own score."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from riskwise.functions.text import text_features
    from riskwise.operators.explain import tree_contributions
    from riskwise.plans import learners as L
    train, _ = _doc_split(spark, sf_dir)
    gbt = L.make_classifier("GradientBoosting", roles.DOC_LABEL)
    stages = L.prep_pipeline(roles.DOC_FEATURES, DOC_ZERO_MISSING).getStages()
    model = Pipeline(stages=[*stages, gbt.copy({gbt.maxIter: 5, gbt.maxDepth: 3})]).fit(train)
    docs = text_features(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")).drop("text")
    rows = L.prepare(docs, roles.DOC_FEATURES, DOC_ZERO_MISSING)
    terms = tree_contributions(model, rows, roles.DOC_FEATURES, ["doc_id"]).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("contribution").alias("made"), F.max("expected").alias("expected"))
    own = model.transform(rows).select("doc_id", vector_to_array("rawPrediction")[1].alias("score"))
    agrees = F.abs(F.col("made") + F.col("expected") - F.col("score")) < 1e-9
    return terms.join(own, "doc_id").select("doc_id", "n_terms", agrees.alias("agrees"))


def q_stream_model_score(spark, sf_dir):
    """T1 with a saved pipeline: every document scored as it arrives, held against the batch scores."""
    from pyspark.ml import Pipeline

    from riskwise.functions.text import text_features
    from riskwise.plans import learners as L
    from riskwise.streaming import feed as ST
    train, _ = _doc_split(spark, sf_dir)
    stages = L.prep_pipeline(roles.DOC_FEATURES, DOC_ZERO_MISSING).getStages()
    path = scratch_path(spark, "stream-model")
    L.save_model(Pipeline(stages=[*stages, L.make_classifier("LogisticRegression", roles.DOC_LABEL)]).fit(train), path)
    model = L.load_model(path)

    def scored(docs):
        rows = text_features(docs.select("doc_id", "text", "n_chars")).drop("text")
        return L.score_records(model, rows, roles.DOC_FEATURES, DOC_ZERO_MISSING, ["doc_id"])

    docs = table(spark, sf_dir, "documents")
    source = (spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
    live = spark.read.parquet(ST.append_stream(spark, scored(source), "model-scored"))
    batch = scored(docs).select("doc_id", F.col("p").alias("batch_p"), F.col("prediction").alias("batch_prediction"))
    same = (F.abs(F.col("p") - F.col("batch_p")) < 1e-12) & (F.col("prediction") == F.col("batch_prediction"))
    return live.join(batch, "doc_id", "left").select("doc_id", *roles.DOC_FEATURES, F.coalesce(same, F.lit(False)).alias("agrees"))


def q_ml_form_checks(spark, sf_dir):
    """The approximate Spark ML forms lie within their bounds of the exact operators."""
    clean = C.zeros_to_null(lineitem(spark, sf_dir).select(*LI.zero_missing), LI.zero_missing)
    fitted = {r["column"]: r["surrogate"] for r in q_imputer_ml_surrogates(spark, sf_dir).collect()}
    shares = clean.agg(*[F.struct(F.try_divide(F.count_if(F.col(c) < v), F.count(c)).alias("below"),
                                  F.try_divide(F.count_if(F.col(c) <= v), F.count(c)).alias("upto")).alias(c)
                         for c, v in fitted.items()]).first()
    rows = [(f"median rank of {c}", shares[c]["below"] <= 0.501 and shares[c]["upto"] >= 0.499) for c in fitted]
    binned, exact = q_auc_binned(spark, sf_dir).first()[0], q_auc_exact(spark, sf_dir).first()[0]
    rows.append(("binned ROC-AUC", abs(binned - exact) <= 0.002))
    return spark.createDataFrame(rows, "check string, ok boolean")


# ---- vector features (embeddings) -------------------------------------------------
def q_embedding_group_means(spark, sf_dir):
    from riskwise.operators import vectors
    return vectors.vector_group_means(table(spark, sf_dir, "embeddings"), "label", "embedding")


def q_embedding_corr(spark, sf_dir):
    from riskwise.operators import vectors
    return vectors.vector_corr(table(spark, sf_dir, "embeddings"), "embedding")


def q_embedding_standardize(spark, sf_dir):
    from riskwise.operators import vectors
    return vectors.vector_standardize(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


# ---- sources and sinks ---------------------------------------------------------------
def q_csv_scan(spark, sf_dir):
    """Write a derived measurement table as header CSV, scan it back with a
    declared schema, profile it."""
    from pyspark.sql import types as T

    from riskwise.sources import files
    path = scratch_path(spark, "csv")
    li_labeled(spark, sf_dir).select(*LI.key, *LI.features, "label").write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType())]
                          + [T.StructField(c, T.DoubleType()) for c in LI.features]
                          + [T.StructField("label", T.IntegerType())])
    back = files.read_csv(spark, path, schema)
    return quality.kpis(back, "label", ["l_quantity", "l_discount"], LI.zero_missing)


def faulty_lines(li: DataFrame) -> DataFrame:
    """lineitem measurements as CSV lines, with a fault in every fifth one or so, chosen by the row's key."""
    fault = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 40

    def field(c, **bad):
        out = F.col(c).cast("string")
        for text, numbers in bad.items():
            out = F.when(fault.isin(*numbers), F.lit(FAULT_TEXTS[text])).otherwise(out)
        return F.coalesce(out, F.lit(""))

    fields = [field("l_orderkey"), field("l_linenumber"), field("l_quantity", missing=[0], text=[3]),
              field("l_extendedprice", missing=[3], nan=[1], infinite=[5]), field("l_discount", text=[2]),
              field("l_tax", missing=[4], nan=[6])]
    return li.select(F.concat(F.concat_ws(",", *fields), F.when(fault == 7, F.lit(",extra")).otherwise(F.lit(""))).alias("value"))


#: What a faulty field holds.
FAULT_TEXTS = {"missing": "", "text": "12x", "nan": "NaN", "infinite": "Infinity"}


def q_quarantine_batch(spark, sf_dir):
    """CSV records with faults by key; good ones are scored, bad ones kept with their reasons."""
    from pyspark.sql import types as T

    from riskwise.sources import files
    li = lineitem(spark, sf_dir)
    path, out = scratch_path(spark, "faulty-csv"), scratch_path(spark, "checked")
    faulty_lines(li).write.text(path)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType())]
                          + [T.StructField(c, T.DoubleType()) for c in LI.features])
    records = files.read_csv_records(spark, path, schema, header=False)
    model = LinearRisk.for_role(li, LI)
    quarantine.write_checked(quarantine.scored(records, quarantine.Check(schema, LI.zero_missing),
                               lambda rows: model.transform(rows).select("kept", "p", "prediction"), ["p", "prediction"]), out)
    rows = quarantine.read_checked(spark, out)
    return rows.select(F.col("entered.l_orderkey").cast("long").alias("l_orderkey"),
                       F.col("entered.l_linenumber").cast("int").alias("l_linenumber"), "accepted",
                       F.concat_ws("; ", "reasons").alias("reasons"), F.round("p", 6).alias("p"), "prediction")


def q_schema_ingest(spark, sf_dir):
    """Enforce a scoring-record schema on raw rows."""
    from pyspark.sql import types as T

    from riskwise.sources import files
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                           T.StructField("l_quantity", T.IntegerType()), T.StructField("l_extendedprice", T.DoubleType()),
                           T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType())])
    return files.to_frame(lineitem(spark, sf_dir), schema)


def q_metrics_json(spark, sf_dir):
    """Metric table written as JSON and read back with its schema."""
    from riskwise.sources import files
    path = scratch_path(spark, "metrics-json")
    files.write_metrics_json(EV.metric_table(li_scored_long(spark, sf_dir)), path)
    return files.read_metrics_json(spark, path)


def q_metrics_document(spark, sf_dir):
    """The whole comparison document (metrics, linear coefficients, best model), written and read back."""
    from riskwise.sources import files
    path = scratch_path(spark, "metrics-document")
    name, weights, intercept = roles.LINEITEM_SCORERS[0]
    files.write_metrics_document(EV.metric_table(li_scored_long(spark, sf_dir)), [n for n, _, _ in roles.LINEITEM_SCORERS],
                                 (name, list(LI.features), [float(w) for w in weights], float(intercept)), path)
    return files.read_metrics_document(spark, path)


def q_model_publication(spark, sf_dir):
    """A scaler published, then replaced by one fitted on all rows; the newest version standardises the table."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from riskwise.plans import learners as L
    clean = C.to_double(C.zeros_to_null(lineitem(spark, sf_dir).select(*LI.key, *LI.features), LI.zero_missing), LI.features)
    filled = fit_impute(clean, LI.zero_missing, "median").transform(clean)
    steps = Pipeline(stages=[VectorAssembler(inputCols=list(LI.features), outputCol="x"),
                             StandardScaler(inputCol="x", outputCol="z", withMean=True, withStd=True)])
    path = scratch_path(spark, "published")
    for rows in (filled.where("l_quantity < 10"), filled):
        L.publish_model(steps.fit(rows), path, rows, LI.features)
    z = L.load_published(filled, path).transform(filled).withColumn("z", vector_to_array("z"))
    return z.select(*LI.key, *[F.round(F.col("z")[i], 6).alias(f"z_{c}") for i, c in enumerate(LI.features)])


def q_predictions_sink(spark, sf_dir):
    """Per-row predictions written as a table and read back."""
    from riskwise.plans.learners import export_predictions
    return export_predictions(q_linear_score(spark, sf_dir), scratch_path(spark, "scores"))


QUERIES = {
    "risk_bands": q_risk_bands,
    "missing_profile": q_missing_profile,
    "kpis": q_kpis,
    "label_counts": q_label_counts,
    "group_means": q_group_means,
    "describe": q_describe,
    "histogram_by_label": q_histogram_by_label,
    "corr_matrix": q_corr_matrix,
    "first_rows": q_first_rows,
    "clip_bounds": q_clip_bounds,
    "median_surrogates": q_median_surrogates,
    "impute_median": q_impute_median,
    "imputer_ml_surrogates": q_imputer_ml_surrogates,
    "standardize_samp": q_standardize_samp,
    "standardize_pop": q_standardize_pop,
    "hash_split": q_hash_split,
    "fold_assign": q_fold_assign,
    "stratified_split": q_stratified_split,
    "linear_score": q_linear_score,
    "score_labels": q_score_labels,
    "margin_to_probability": q_margin_to_probability,
    "contributions": q_contributions,
    "guidance_rules": q_guidance_rules,
    "guidance_table": q_guidance_table,
    "report_text": q_report_text,
    "confusion": q_confusion,
    "classification_metrics": q_classification_metrics,
    "roc_curve": q_roc_curve,
    "roc_points": q_roc_points,
    "roc_reduced": q_roc_reduced,
    "roc_auc_trapezoid": q_roc_auc_trapezoid,
    "auc_exact": q_auc_exact,
    "auc_binned": q_auc_binned,
    "metrics_unpivot": q_metrics_unpivot,
    "metrics_pivot": q_metrics_pivot,
    "leaderboard": q_leaderboard,
    "coef_rank": q_coef_rank,
    "metric_labels": q_metric_labels,
    "feed_score": q_feed_score,
    "last20_rate": q_last20_rate,
    "newest20": q_newest20,
    "timeline": q_timeline,
    "feed_kpis": q_feed_kpis,
    "stream_score": q_stream_score,
    "quarantine_batch": q_quarantine_batch,
    "quarantine_stream": q_quarantine_stream,
    "stream_last20": q_stream_last20,
    "stream_trend": q_stream_trend,
    "doc_features": q_doc_features,
    "train_lr": _train_query("LogisticRegression"),
    "train_dt": _train_query("DecisionTree"),
    "train_rf": _train_query("RandomForest"),
    "train_gbt": _train_query("GradientBoosting"),
    "train_svc": _train_query("SupportVectorMachine"),
    "grid_cv": q_grid_cv,
    "fit_accuracy": q_fit_accuracy,
    "champion": q_champion,
    "save_load_score": q_save_load_score,
    "lr_coefficients": q_lr_coefficients,
    "learner_checks": q_learner_checks,
    "tuning_checks": q_tuning_checks,
    "tree_contributions": q_tree_contributions,
    "stream_model_score": q_stream_model_score,
    "ml_form_checks": q_ml_form_checks,
    "embedding_group_means": q_embedding_group_means,
    "embedding_corr": q_embedding_corr,
    "embedding_standardize": q_embedding_standardize,
    "csv_scan": q_csv_scan,
    "schema_ingest": q_schema_ingest,
    "metrics_json": q_metrics_json,
    "metrics_document": q_metrics_document,
    "predictions_sink": q_predictions_sink,
    "model_publication": q_model_publication,
}
