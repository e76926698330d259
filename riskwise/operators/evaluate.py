"""Model evaluation on a score column.

Confusion-based metrics come from one grouped count (at most models x 4 rows);
the exact ROC-AUC from per-score counts and distributed running totals; the
bucketed ROC curve from at most 10,001 score buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskwise.operators.ordered import running_totals
from riskwise.session import shared_dir

METRICS = ("accuracy", "roc_auc", "f1_score", "precision", "recall")


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction",
              group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., label, prediction, n)."""
    return df.groupBy(*group_cols, F.col(label).alias("label"), F.col(pred).alias("prediction")) \
             .agg(F.count(F.lit(1)).alias("n"))


def _round(x, digits):
    """Round to ``digits`` places; ``None`` keeps full precision (format later)."""
    return x if digits is None else F.round(x, digits)


def _ratio(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "prediction",
                           group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Accuracy, label-weighted precision/recall/F1 (the evaluator's
    ``weightedPrecision``/``weightedRecall``/``f1``) and positive-class
    precision/recall/F1 for a 0/1 label, per group.

    A row whose prediction is NULL or not 0/1 counts as wrong for its class; a label that
    is NULL or not 0/1 is an error."""
    conf = confusion(df, label, pred, group_cols)

    def cnt(lv, pv):
        return F.sum(F.when((F.col("label") == lv) & (F.col("prediction") == pv), F.col("n")).otherwise(0))

    def rows(lv):
        return F.sum(F.when(F.col("label") == lv, F.col("n")).otherwise(0))

    odd = F.sum(F.when(F.col("label").isin(0, 1), 0).otherwise(F.col("n")))
    c = conf.groupBy(*group_cols).agg(
        cnt(1, 1).alias("tp"), cnt(0, 1).alias("fp"), cnt(1, 0).alias("fn"), cnt(0, 0).alias("tn"),
        rows(0).alias("neg"), rows(1).alias("pos"), odd.alias("odd"))
    return _metrics(c, group_cols, digits)


def _metrics(c: DataFrame, group_cols: Sequence[str], digits) -> DataFrame:
    """The seven metrics from one row of counts per group."""
    odd = F.coalesce(F.col("odd"), F.lit(0))
    c = c.withColumn("pos", F.when(odd > 0, F.raise_error(F.concat(
        odd.cast("string"), F.lit(" rows have a label other than 0 and 1"))).cast("long")).otherwise(F.col("pos")))
    n = F.col("neg") + F.col("pos")
    p1, r1 = _ratio(F.col("tp"), F.col("tp") + F.col("fp")), _ratio(F.col("tp"), F.col("pos"))
    p0, r0 = _ratio(F.col("tn"), F.col("tn") + F.col("fn")), _ratio(F.col("tn"), F.col("neg"))

    def f1(p, r):
        return _ratio(F.lit(2.0) * p * r, p + r)

    w1, w0 = _ratio(F.col("pos"), n), _ratio(F.col("neg"), n)
    return c.select(
        *group_cols,
        _round(_ratio(F.col("tp") + F.col("tn"), n), digits).alias("accuracy"),
        _round(p1 * w1 + p0 * w0, digits).alias("precision"),
        _round(r1 * w1 + r0 * w0, digits).alias("recall"),
        _round(f1(p1, r1) * w1 + f1(p0, r0) * w0, digits).alias("f1_score"),
        _round(p1, digits).alias("precision_pos"),
        _round(r1, digits).alias("recall_pos"),
        _round(f1(p1, r1), digits).alias("f1_pos"),
    )


COUNTS = ("tp", "fp", "fn", "tn", "pos", "neg", "odd")


def score_counts(df: DataFrame, score: str = "p", label: str = "label", pred: str = "prediction",
                 group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per (group, score) with all that confusion, ROC-AUC and ROC curve count, stored once.

    The scored rows are read a single time, however many of the three are asked for; the counts
    of parts of a table add up.  Columns: ``score`` and ``tp, fp, fn, tn, pos, neg, odd`` (rows with another label).
    """
    y, yhat = F.col(label), F.col(pred)
    counts = df.groupBy(*group_cols, F.col(score).cast("double").alias("score")).agg(
        F.count_if((y == 1) & (yhat == 1)).alias("tp"), F.count_if((y == 0) & (yhat == 1)).alias("fp"),
        F.count_if((y == 1) & (yhat == 0)).alias("fn"), F.count_if((y == 0) & (yhat == 0)).alias("tn"),
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"),
        F.count_if(~F.coalesce(y.isin(0, 1), F.lit(False))).alias("odd"))
    shared_dir(df.sparkSession)
    return counts.checkpoint(eager=True)


def metrics_of_counts(counts: DataFrame, group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """A11/A12/A14 from :func:`score_counts`."""
    return _metrics(counts.groupBy(*group_cols).agg(*[F.sum(c).alias(c) for c in COUNTS]), group_cols, digits)


def _ranked(counts: DataFrame) -> DataFrame:
    """The counts that can be ranked: those with a score, and with a 0/1 label."""
    return counts.where(F.col("score").isNotNull() & ~F.isnan("score") & (F.col("pos") + F.col("neg") > 0))


def auc_of_counts(counts: DataFrame, group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """A13 from :func:`score_counts`; a class missing from a group gives NULL."""
    rt = running_totals(_ranked(counts), "score", ["neg"], group_cols)
    return rt.groupBy(*group_cols).agg(
        _round(F.try_divide(
            F.sum(F.col("pos").cast("double") * (F.col("before_neg").cast("double") + 0.5 * F.col("neg"))),
            F.sum("pos").cast("double") * F.sum("neg").cast("double")), digits).alias("roc_auc"))


def _scored(df: DataFrame, score: str, label: str) -> DataFrame:
    s = F.col(score)
    return df.where(s.isNotNull() & ~F.isnan(s.cast("double")) & F.col(label).isin(0, 1))


def auc_exact(df: DataFrame, score: str = "p", label: str = "label",
              group_cols: Sequence[str] = (), digits: int = 6, reuse: bool = True) -> DataFrame:
    """Exact ROC-AUC (ties count one half), i.e. the midrank statistic.

    Rows are first reduced to one row per distinct score (partial aggregation),
    then ``neg_below`` comes from distributed running totals.  A class missing
    from a group gives NULL (AUC undefined).  Rows without a score (NULL or NaN) or
    without a 0/1 label cannot be ranked and are left out, here and in ``roc_curve``.
    """
    counts = (_scored(df, score, label).groupBy(*group_cols, F.col(score).alias("__s"))
              .agg(F.sum(F.col(label).cast("long")).alias("pos"),
                   F.sum((1 - F.col(label)).cast("long")).alias("neg")))
    if reuse:
        # the per-score table is read three times (size, sketch, totals); a reliable
        # checkpoint in the shared folder stores it once and cuts the lineage
        shared_dir(df.sparkSession)
        counts = counts.checkpoint(eager=True)
    rt = running_totals(counts, "__s", ["neg"], group_cols)
    return rt.groupBy(*group_cols).agg(
        _round(F.try_divide(
            F.sum(F.col("pos").cast("double") * (F.col("before_neg").cast("double") + 0.5 * F.col("neg"))),
            F.sum("pos").cast("double") * F.sum("neg").cast("double")), digits).alias("roc_auc"))


def roc_curve(df: DataFrame, score: str = "p", label: str = "label", resolution: float = 1e-4,
              digits: int = 6) -> DataFrame:
    """ROC points at score thresholds on a ``resolution`` grid.

    Scores are bucketed first (at most 1/resolution + 1 buckets), so the
    cumulative window runs over a bounded table regardless of the row count; a score
    outside 0..1 is an error.  A row is predicted positive at threshold t when its bucket >= t.
    ``roc_points`` has a point at every score.
    """
    steps = int(round(1 / resolution))
    b = (_scored(df, score, label).groupBy(F.floor(F.col(score) * steps).cast("long").alias("bucket"))
         .agg(F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg"),
              F.min(score).alias("lo"), F.max(score).alias("hi")))
    # the range is checked once per bucket: per row, the check would hold the whole score expression again
    fits = (F.col("lo") >= 0) & (F.col("hi") <= 1)
    b = b.withColumn("bucket", F.when(fits, F.col("bucket")).otherwise(
        F.raise_error(F.lit("ROC buckets need scores in 0..1")).cast("long"))).drop("lo", "hi")
    w = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0)
    wall = Window.partitionBy(F.lit(1))
    out = (b.withColumn("tp", F.sum("pos").over(w)).withColumn("fp", F.sum("neg").over(w))
           .withColumn("P", F.sum("pos").over(wall)).withColumn("N", F.sum("neg").over(wall)))
    return out.select(
        F.round(F.col("bucket") / F.lit(float(steps)), digits).alias("threshold"),
        "tp", "fp",
        F.round(F.try_divide(F.col("tp").cast("double"), F.col("P").cast("double")), digits).alias("tpr"),
        F.round(F.try_divide(F.col("fp").cast("double"), F.col("N").cast("double")), digits).alias("fpr"))


def roc_points(df: DataFrame, score: str = "p", label: str = "label", digits: int = 6, reduce: bool = False) -> DataFrame:
    """ROC points at every distinct score: (threshold, tp, fp, tpr, fpr).

    A row is predicted positive at a threshold when its score is not below it.  Counts come from
    distributed running totals, so no window spans the whole table.

    ``reduce`` leaves out every point between the first and the last that lies half way between its neighbours: the
    step into it and the step out of it add the same positives and negatives.  That changes no area under the curve.
    """
    counts = (_scored(df, score, label).groupBy(F.col(score).cast("double").alias("threshold"))
              .agg(F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg")))
    shared_dir(df.sparkSession)
    counts = counts.checkpoint(eager=True)
    total = counts.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    P, N = F.lit(total["pos"] or 0).cast("long"), F.lit(total["neg"] or 0).cast("long")
    rt = running_totals(counts, "threshold", ["pos", "neg"], previous=["pos", "neg"] if reduce else ())
    if reduce:
        first = (F.col("before_pos") + F.col("pos") == P) & (F.col("before_neg") + F.col("neg") == N)
        turn = (F.col("pos") != F.col("prev_pos")) | (F.col("neg") != F.col("prev_neg"))
        rt = rt.where(first | F.col("prev_pos").isNull() | turn)
    return (rt.select("threshold", (P - F.col("before_pos")).alias("tp"), (N - F.col("before_neg")).alias("fp"))
            .withColumn("tpr", F.round(F.try_divide(F.col("tp").cast("double"), P.cast("double")), digits))
            .withColumn("fpr", F.round(F.try_divide(F.col("fp").cast("double"), N.cast("double")), digits)))


def trapezoid_auc(roc: DataFrame, digits: int = 6) -> DataFrame:
    """Area under the bucketed curve from (0, 0), via ``lag`` over its counts; rounded once, at the end."""
    w = Window.orderBy(F.col("fp"), F.col("tp"))
    seg = (roc.select(F.col("fp").cast("double"), F.col("tp").cast("double"))
           .withColumn("pf", F.lag("fp", 1, 0.0).over(w)).withColumn("pt", F.lag("tp", 1, 0.0).over(w)))
    area = F.sum((F.col("fp") - F.col("pf")) * (F.col("tp") + F.col("pt")) / 2.0)
    return seg.agg(F.round(F.try_divide(area, F.max("fp") * F.max("tp")), digits).alias("auc_trapezoid"))


def metric_table(scored_long: DataFrame, model_col: str = "model", score: str = "p",
                 label: str = "label", pred: str = "prediction", digits: int = 6) -> DataFrame:
    """Tall (model, metric, score) table of the five reported metrics, from one pass over the scored rows."""
    counts = score_counts(scored_long, score, label, pred, [model_col])
    cls, auc = metrics_of_counts(counts, [model_col], digits), auc_of_counts(counts, [model_col], digits)
    wide = cls.join(auc, model_col)
    return wide.unpivot([model_col], list(METRICS), "metric", "score")


def metric_pivot(tall: DataFrame, model_col: str = "model") -> DataFrame:
    """Tall metrics back to one row per model."""
    return tall.groupBy(model_col).pivot("metric", list(METRICS)).agg(F.first("score"))


def leaderboard(wide: DataFrame, order: dict, metric: str = "roc_auc", model_col: str = "model") -> DataFrame:
    """Rank models by ``metric`` (descending); ties go to the earlier model,
    as a strict ``>`` scan does.  ``order`` maps model -> position."""
    pos = F.lit(None).cast("int")
    for m, i in order.items():
        pos = F.when(F.col(model_col) == m, F.lit(i)).otherwise(pos)
    w = Window.orderBy(F.desc_nulls_last(metric), pos)
    return (wide.select(model_col, metric).withColumn("rank", F.row_number().over(w))
            .withColumn("champion", F.col("rank") == 1))


def coef_rank(coefs: DataFrame, weight: str = "weight") -> DataFrame:
    """L4: coefficients ordered by absolute weight, ascending, with their position."""
    w = Window.orderBy(F.abs(F.col(weight)), F.col("feature"))
    return coefs.withColumn("abs_rank", F.row_number().over(w))
