"""Feed operators over an event table (T1/T2 scoring, W1, L2, L3, A16).

The clinical "live feed" scores each arriving record, keeps the newest 20 and
shows the positive rate over them.  Here a feed is a key (one feed per
``event_type``), records are ordered by (event time, id), and the same results
are computed for every record of every feed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskwise import roles
from riskwise.functions import columns as C
from riskwise.operators.prep import ScaleModel
from riskwise.operators.quantiles import sketch_points
from riskwise.session import saved


def with_k(events: DataFrame) -> DataFrame:
    """Extract the numeric ``k`` attribute from the JSON ``props`` column (NULL if it is not a number)."""
    return events.withColumn("k", F.get_json_object("props", "$.k").try_cast("double"))


@dataclass
class FeedScorer:
    """Clip -> z-score -> linear link -> risk %, diagnosis, tag, clock.

    Fitted state is a mean and a std per feature (two scalars), so the same
    object scores a batch table and a stream.
    """

    mean: dict
    std: dict
    weights: tuple = roles.FEED_WEIGHTS
    intercept: float = roles.FEED_INTERCEPT
    clip: dict = None

    @classmethod
    def fit(cls, events: DataFrame, features: Sequence[str] = roles.FEED_FEATURES,
            clip: dict = roles.FEED_CLIP) -> "FeedScorer":
        x = C.clip_columns(with_k(events).select(*features), clip)
        aggs = []
        for i, c in enumerate(features):
            aggs += [F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}")]
        row = x.agg(*aggs).first()
        return cls({c: row[f"m{i}"] for i, c in enumerate(features)},
                   {c: row[f"s{i}"] for i, c in enumerate(features)}, clip=dict(clip))

    def transform(self, events: DataFrame, extract: bool = True) -> DataFrame:
        """Adds the scores; ``extract=False`` takes the features as they are, instead of ``k`` from ``props``."""
        x = C.clip_columns(with_k(events) if extract else events, self.clip)
        scaled = ScaleModel(self.mean, self.std, suffix="__z")  # a constant feature scales to 0
        x = scaled.transform(x)
        z = [F.col(f"{c}__z") for c in self.mean]
        p = C.sigmoid(C.linear_margin(z, self.weights, self.intercept))
        pred = (p > roles.DECISION_THRESHOLD).cast("int")
        return x.withColumns({
            "p": p,
            "prediction": pred,
            "risk_pct": C.risk_pct(p, 1),
        }).withColumns({
            "diagnosis": C.outcome_word("prediction", roles.FEED_DIAGNOSIS),
            "tag": C.record_tag(roles.FEED_ID, "PT"),
            "clock": C.clock(roles.FEED_TIME),
        }).drop(*[f"{c}__z" for c in self.mean])


ROWS_PER_SLICE = 1_000_000
SPLITS = 64               # ranges that an over-full slice is cut into
BROADCAST_ROWS = 500_000  # rows of a slice table up to which it is sent to every task


def _null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` in which NULL equals NULL; the columns come from the left."""
    other = right.withColumnsRenamed({c: f"__r_{c}" for c in cols})
    on = F.lit(True)
    for c in cols:
        on = on & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(other, on, how).drop(*[f"__r_{c}" for c in cols])


def _hinted(df: DataFrame, rows: int) -> DataFrame:
    """Sent to every task if it is known to be small, else left to the planner."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _cut_full(rows: DataFrame, at: Sequence[str], value: Column, name: str, limit: int, within: Column | None = None) -> DataFrame:
    """Adds ``name``: the range of ``value`` in slices (columns ``at``) of more than twice ``limit`` rows, else 0.

    The range ends are quantiles from a sketch of the over-full slices alone.  An end is a range of its own, so that
    one hot value is apart from its neighbours.  With ``within``, only slices of one value of that are cut.
    """
    counts = [F.count(F.lit(1)).alias("__n")]
    single = F.lit(True)
    if within is not None:
        counts += [F.min(within).alias("__lo"), F.max(within).alias("__hi")]
        single = F.col("__lo").eqNullSafe(F.col("__hi"))
    full = rows.groupBy(*at).agg(*counts).where((F.col("__n") > 2 * limit) & single).select(*at)
    n = full.count()
    if not n:
        return rows.withColumn(name, F.lit(0))
    cuts = (_null_safe(rows, _hinted(full, n), at).groupBy(*at).agg(F.kll_sketch_agg_double(value).alias("__k"))
            .select(*at, sketch_points("__k", [i / SPLITS for i in range(1, SPLITS)]).alias("__cuts")))
    cuts = saved(cuts)                                     # a sketch is random: all later reads must see the same ends
    joined = _null_safe(rows, _hinted(cuts, n), at, "left")
    place = F.size(F.filter("__cuts", lambda c: c <= value)) + F.size(F.filter("__cuts", lambda c: c < value))
    return joined.withColumn(name, F.when(F.col("__cuts").isNull() | value.isNull(), 0).otherwise(place)).drop("__cuts")


def _sliced(df: DataFrame, keys: Sequence[str], ts: str, tie: str, limit: int) -> tuple[DataFrame, bool]:
    """Adds ``__sid``: consecutive slices, in order of (ts, tie), of the feeds of more than twice ``limit`` rows.

    Every such feed is cut into equal stretches of time, as many as it has ``limit`` rows; stretches that hold far more
    are cut again, by time and then by ``tie`` (a burst, or records without a time).  Neighbours are put together
    until they hold ``limit`` rows.  All tables of slices have about rows / limit rows.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    feeds = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(us).alias("__from"), F.max(us).alias("__to"))
    total = feeds.agg(F.sum("__n").alias("n"), F.max("__n").alias("most")).first()
    limit = max(limit, (total["n"] or 0) // 200_000)
    if (total["most"] or 0) <= 2 * limit:
        return df.withColumn("__sid", F.lit(0).cast("long")), False
    big = feeds.where(F.col("__n") > 2 * limit)            # at most 100,000 rows
    width = F.greatest(F.lit(1).cast("double"), (F.col("__to") - F.col("__from") + 1) * float(limit) / F.col("__n"))
    # a NULL time sorts first (ascending NULLS FIRST), so it gets the lowest slice
    rows = _null_safe(df, F.broadcast(big.withColumn("__width", width).drop("__n", "__to")), keys, "left")
    stretch = F.coalesce(F.floor((us - F.col("__from")) / F.col("__width")).cast("long"), F.lit(-1))
    cut = rows.where("__from is not null or __width is not null")
    cut = cut.withColumn("__b", F.when(us.isNull(), F.lit(-1)).otherwise(stretch)).drop("__from", "__width")
    part, time = [*keys, "__b"], us.cast("double")
    whole = df.schema[tie].dataType.typeName() in ("long", "integer", "short", "byte", "double", "float")
    for name in ("__t1", "__t2", *(("__i1", "__i2") if whole else ())):
        by_time = name.startswith("__t")
        cut = _cut_full(cut, part, time if by_time else F.col(tie).cast("double"), name, limit, None if by_time else time)
        part = [*part, name]
    slices = cut.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(*part[len(keys):]).rowsBetween(Window.unboundedPreceding, -1)
    sid = F.floor(F.coalesce(F.sum("__n").over(before), F.lit(0)) / F.lit(limit)).cast("long")
    slices = saved(slices.withColumn("__sid", sid).drop("__n"))
    cut = _null_safe(cut, _hinted(slices, slices.count()), part).drop(*part[len(keys):])
    small = rows.where("__from is null and __width is null").drop("__from", "__width")
    return cut.unionByName(small.withColumn("__sid", F.lit(0).cast("long"))), True


def _halo(rows: DataFrame, keys: Sequence[str], ts: str, tie: str, n: int) -> DataFrame:
    """For every slice, the last ``n`` rows of its feed before it, with that slice's ``__sid``.

    Each slice hands on its last ``n`` rows at most; they are numbered along the feed, and a slice takes those
    whose numbers come right before its own first one, so slices shorter than ``n`` are reached across.
    """
    last = Window.partitionBy(*keys, "__sid").orderBy(F.desc(ts), F.desc(tie))
    tails = rows.withColumn("__r", F.row_number().over(last)).where(F.col("__r") <= n).drop("__r")
    along = Window.partitionBy(*keys).orderBy("__sid", ts, tie)
    tails = saved(tails.withColumn("__c", F.row_number().over(along)))
    ends = tails.groupBy(*keys, "__sid").agg(F.max("__c").alias("__m"))
    starts = ends.withColumn("__at", F.lag("__m").over(Window.partitionBy(*keys).orderBy("__sid"))).where("__at is not null")
    copies = tails.drop("__sid").withColumn("__at", F.explode(F.sequence(F.col("__c"), F.col("__c") + F.lit(n - 1)))).drop("__c")
    return _null_safe(copies, starts.drop("__m"), [*keys, "__at"]).drop("__at")


def rolling_rate(df: DataFrame, key: str | Sequence[str], ts: str, tie: str, flag: str, n: int = roles.FEED_HISTORY,
                 rows_per_slice: int = ROWS_PER_SLICE, also: dict | None = None) -> DataFrame:
    """Per record, the count and the positive rate over the last ``n`` records of
    its feed (ordered by ``ts``, ``tie``) - a ROWS frame of ``n - 1`` preceding.

    A plain ``Window.partitionBy(key)`` puts a whole feed in one task; a feed
    holding a third of all records would make that task a third of the job.
    Instead, large feeds are cut into slices of about ``rows_per_slice`` consecutive records (``_sliced``), and every slice
    gets a halo: the ``n - 1`` records of its feed before it (``_halo``).  Then one ordinary frame inside each
    slice gives every record its whole window.  Each record is shuffled once; beyond it only ``n - 1`` per
    slice are.  A feed whose records all carry one time, or none, is cut by ``tie``.

    ``also`` maps further output names to columns that are summed over the same frame.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows, cut = _sliced(df, keys, ts, tie, rows_per_slice)
    rows = rows.withColumn("__halo", F.lit(False))
    if cut:
        near = _halo(rows, keys, ts, tie, n - 1) if n > 1 else rows.where("false")
        rows = rows.unionByName(near.withColumn("__halo", F.lit(True)))
    frame = Window.partitionBy(*keys, "__sid").orderBy(ts, tie).rowsBetween(-(n - 1), 0)
    sums = {"n_pos": F.coalesce(F.col(flag).cast("long"), F.lit(0)), **(also or {})}
    out = rows.withColumn("n_window", F.count(F.lit(1)).over(frame))
    out = out.withColumns({name: F.sum(c).over(frame) for name, c in sums.items()}).where("not __halo")
    return (out.select(*df.columns, "n_window", *sums)
            .withColumn("pos_rate", F.round(F.col("n_pos").cast("double") / F.col("n_window").cast("double"), 6)))


def newest_per_key(df: DataFrame, key: str, ts: str, tie: str, n: int = roles.FEED_HISTORY) -> DataFrame:
    """L2: the newest ``n`` records of every feed, with position 1 = newest.

    ``row_number() <= n`` is planned with a partial ``WindowGroupLimit`` before the
    shuffle, so each task forwards at most n rows per feed.
    """
    w = Window.partitionBy(key).orderBy(F.desc(ts), F.desc(tie))
    return df.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


def timeline(df: DataFrame, ts: str, tie: str, n: int = roles.FEED_HISTORY) -> DataFrame:
    """L2 + L3: the newest ``n`` records overall, numbered oldest -> newest.

    ``orderBy(...).limit(n)`` is a TakeOrdered (per-task top-n); the numbering
    window then runs over n rows.
    """
    top = df.orderBy(F.desc(ts), F.desc(tie)).limit(n)
    return top.withColumn("step", F.row_number().over(Window.orderBy(ts, tie)))


def feed_kpis(newest: DataFrame, key: str, flag: str = "prediction", risk: str = "risk_pct") -> DataFrame:
    """Per feed over its retained records: count, positive %, latest risk."""
    return newest.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_retained"),
        F.round(F.sum(F.col(flag).cast("long")).cast("double") * 100.0 / F.count(F.lit(1)).cast("double"), 6)
        .alias("positive_pct"),
        F.max(F.when(F.col("position") == 1, F.col(risk))).alias("latest_risk_pct"))
