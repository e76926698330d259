"""Exact quantiles without gathering a column into one task.

Spark's ``percentile``/``percentile_disc`` aggregate keeps every distinct value of
a group in one buffer; for a global median of a high-cardinality column the final
merge holds the whole column in a single task.  ``Imputer`` uses an approximate
sketch instead, which is bounded but not exact.

Here the exact k-th smallest value is found by narrowing a value range:

1. one scan gives ``count/min/max`` per column and an approximate-quantile sketch,
   merged in two levels, whose rank error brackets each wanted value;
2. each pass histograms the rows that fall inside the current range of every open
   probe into ``BINS`` equal-width bins (``groupBy(probe, bin)`` with map-side
   partial aggregation, so a pass shuffles at most ``probes * BINS`` rows per
   task), keeping count, min and max per bin, and counts the rows below the range;
3. the bin holding rank k becomes the next range (tightened to the bin's real
   min/max).  A bin whose min equals its max is a single value - a hot value that
   holds a third of the table is resolved in one pass;
4. once the bin holds at most ``FINISH`` rows, its (value, count) pairs are read
   and the rank is resolved exactly.

Every collected result is bounded by ``probes * BINS`` (or ``FINISH``) rows,
independent of the table size.  Binning is monotone in IEEE arithmetic, so bins
are contiguous value intervals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 4096
FINISH = 20000


def disc_rank(p: float, n: int) -> int:
    """1-based rank of ``percentile_disc(p)``: smallest value with cume_dist >= p."""
    return min(n, max(1, math.ceil(p * n - 1e-9)))


def valid(c: str):
    """The column as double, NULL where it is NULL or NaN (NaN has no rank)."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _long(df: DataFrame, cols: Sequence[str], only=None) -> DataFrame:
    """(ci, x) pairs for the non-null, non-NaN values of ``cols`` (or of the column
    indexes in ``only``: the scan then reads just those columns)."""
    arr = F.array(*[F.struct(F.lit(i).alias("ci"), F.col(c).cast("double").alias("x"))
                    for i, c in enumerate(cols) if only is None or i in only])
    return (df.select(F.explode(arr).alias("s"))
            .select("s.ci", "s.x")
            .where(F.col("x").isNotNull() & ~F.isnan("x")))


SKETCH_K = 4096       # KLL sketch of about 100 KB, rank error about 0.0013 of the rows
SKETCH_ERROR = 2e-3   # half width of the bracket around a wanted quantile
SKETCH_GROUPS = 256   # sketches that reach the last merge


def task_group():
    """Group of the running task.  Summaries are merged per group first, so that the last merge gets at
    most ``SKETCH_GROUPS`` of them and not one for every task of the scan."""
    return (F.spark_partition_id() % SKETCH_GROUPS).alias("__g")


def sketch_points(sketch: str, probs: Sequence[float]):
    """Approximate quantiles of a merged KLL sketch; NULL if it holds no value."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0,
                  F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(p)) for p in probs])))


def column_stats(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = ()):
    """One scan: per column ``s<i> = (n, lo, hi[, q])`` over the rankable values,
    with ``q`` approximate quantiles at ``probs`` (used as brackets)."""
    part, merge, out = [], [], []
    for i, c in enumerate(cols):
        x = valid(c)
        part += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        merge += [F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}"), F.min(f"lo{i}").alias(f"lo{i}"),
                  F.max(f"hi{i}").alias(f"hi{i}")]
        fields = [F.col(f"{f}{i}").alias(f) for f in ("n", "lo", "hi")]
        if probs:
            part.append(F.kll_sketch_agg_double(x, SKETCH_K).alias(f"k{i}"))
            merge.append(F.kll_merge_agg_double(f"k{i}", SKETCH_K).alias(f"k{i}"))
            fields.append(F.when(F.col(f"n{i}") > 0, sketch_points(f"k{i}", probs)).alias("q"))
        out.append(F.struct(*fields).alias(f"s{i}"))
    return df.groupBy(task_group()).agg(*part).agg(*merge).select(*out).first()


def kth_values(df: DataFrame, cols: Sequence[str], ranks: dict, stats=None, hints: dict | None = None,
               below: dict | None = None) -> dict:
    """Exact k-th smallest values.

    ``ranks`` maps column name -> list of 1-based ranks.  Returns
    ``{(col, rank): value}``.  ``stats`` may pass a ``column_stats`` row;
    ``hints`` may give a starting value range per (col, rank) - a wrong hint only
    costs a pass, the result stays exact.  If ``below`` is a dict it receives, per
    (col, rank), the number of values strictly smaller than the k-th value.
    Values are ranked as doubles: integers beyond 2**53 must be narrowed first.
    """
    cols = list(cols)
    if not cols:
        return {}
    if stats is None:
        stats = column_stats(df, cols)
    hints = hints or {}
    result: dict = {}
    full: dict = {}
    # open probes: (ci, k, lo, hi) - rank k counted over the whole column; every
    # pass also counts the rows below lo, so a range needs no bookkeeping
    probes = []
    for ci, c in enumerate(cols):
        s = stats[f"s{ci}"]
        full[ci] = (s["lo"], s["hi"])
        for k in ranks.get(c, []):
            if s["n"] == 0 or k < 1 or k > s["n"]:
                result[(c, k)] = None
            elif s["lo"] == s["hi"]:
                result[(c, k)] = s["lo"]
                if below is not None:
                    below[(c, k)] = 0
            else:
                lo, hi = hints.get((c, k), (s["lo"], s["hi"]))
                if lo is None or hi is None or not (s["lo"] <= lo <= hi <= s["hi"]):
                    lo, hi = s["lo"], s["hi"]
                probes.append((ci, k, lo, hi))
    spark = df.sparkSession

    def range_table(rs):
        # one row per open range: a proven, tiny size for the broadcast
        return spark.createDataFrame([(i, ci, lo, hi) for i, (ci, lo, hi) in enumerate(rs)],
                                     "rid int, ci int, lo double, hi double")

    while probes:
        # only columns with an open probe are read in this pass (column pruning)
        long = _long(df, cols, {ci for ci, _, _, _ in probes})
        ranges = sorted({(ci, lo, hi) for ci, _, lo, hi in probes})  # shared ranges: one histogram
        rid = {r: i for i, r in enumerate(ranges)}
        joined = long.join(F.broadcast(range_table(ranges)), "ci").where(F.col("x") <= F.col("hi"))
        width = F.col("hi") - F.col("lo")
        b = (F.when(F.col("x") < F.col("lo"), F.lit(-1))
             .when(width == 0, F.lit(0))  # a one-value range (CASE is lazy: no division by zero)
             .otherwise(F.least(F.floor((F.col("x") - F.col("lo")) / width * F.lit(BINS)),
                                F.lit(BINS - 1)).cast("int")))
        hist = (joined.withColumn("b", b).groupBy("rid", "b")
                .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx"))
                .collect())
        bins: dict = {}
        for r in hist:
            bins.setdefault(r["rid"], []).append((r["b"], r["n"], r["mn"], r["mx"]))
        for v in bins.values():
            v.sort()
        nxt, finish = [], []
        for ci, k, lo, hi in probes:
            hb = bins.get(rid[(ci, lo, hi)], [])
            acc = sum(n for bb, n, _, _ in hb if bb < 0)  # rows below the range
            found = False
            for bb, n, mn, mx in hb:
                if bb < 0:
                    continue
                if acc + n >= k and acc < k:
                    if mn == mx:
                        result[(cols[ci], k)] = mn
                        if below is not None:
                            below[(cols[ci], k)] = acc
                    elif n <= FINISH:
                        finish.append((ci, k, mn, mx))
                    else:
                        nxt.append((ci, k, mn, mx))
                    found = True
                    break
                acc += n
            if not found:
                if (lo, hi) == full[ci]:  # pragma: no cover - ranks were checked against n
                    raise RuntimeError("rank outside histogram")
                nxt.append((ci, k) + full[ci])  # the hint missed: one more pass over the full range
        if finish:
            long = _long(df, cols, {ci for ci, _, _, _ in finish})
            fr = sorted({(ci, lo, hi) for ci, _, lo, hi in finish})
            fid = {r: i for i, r in enumerate(fr)}
            vals = (long.join(F.broadcast(range_table(fr)), "ci").where(F.col("x") <= F.col("hi"))
                    .withColumn("x", F.when(F.col("x") >= F.col("lo"), F.col("x")))  # NULL = below the range
                    .groupBy("rid", "x").agg(F.count(F.lit(1)).alias("n"))
                    .collect())
            per: dict = {}
            for r in vals:
                per.setdefault(r["rid"], []).append((r["x"], r["n"]))
            for ci, k, lo, hi in finish:
                pairs = per.get(fid[(ci, lo, hi)], [])
                acc = sum(n for x, n in pairs if x is None)
                for x, n in sorted((x, n) for x, n in pairs if x is not None):
                    if acc + n >= k:
                        result[(cols[ci], k)] = x
                        if below is not None:
                            below[(cols[ci], k)] = acc
                        break
                    acc += n
        probes = nxt
    return result


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    method: str = "disc") -> dict:
    """Exact quantiles per column: ``{(col, p): value}``.

    ``method='disc'`` is ``percentile_disc`` (an observed value);
    ``method='cont'`` is ``percentile``/``quantile_cont`` (linear interpolation
    between the values at 0-based positions floor((n-1)p) and ceil((n-1)p)).

    The first scan also sketches each quantile at p -/+ ``SKETCH_ERROR``; that bracket holds the
    exact value (if not, narrowing starts again from the whole range), so narrowing starts from
    about 2 ``SKETCH_ERROR`` of the rows.
    """
    cols = list(cols)
    eps = SKETCH_ERROR
    brackets = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-eps, eps)})
    stats = column_stats(df, cols, brackets)
    ranks: dict = {}
    plan: dict = {}
    hints: dict = {}
    for i, c in enumerate(cols):
        s = stats[f"s{i}"]
        n = s["n"]
        sketch = dict(zip(brackets, s["q"] or [])) if n else {}
        for p in probs:
            if n == 0:
                plan[(c, p)] = None
                continue
            if method == "disc":
                ks = [disc_rank(p, n)]
                plan[(c, p)] = ("d", ks[0])
            else:
                pos = (n - 1) * p
                lo, hi = math.floor(pos), math.ceil(pos)
                ks = [lo + 1, hi + 1]
                plan[(c, p)] = ("c", lo + 1, hi + 1, pos - lo)
            ranks.setdefault(c, set()).update(ks)
            if n * eps >= 4 and sketch:  # the bracket is only worth it on large columns
                bl = sketch.get(min(1.0, max(0.0, p - eps)))
                bh = sketch.get(min(1.0, max(0.0, p + eps)))
                for k in ks:
                    hints[(c, k)] = (bl, bh)
    vals = kth_values(df, cols, {c: sorted(v) for c, v in ranks.items()}, stats, hints)
    out = {}
    for (c, p), spec in plan.items():
        if spec is None:
            out[(c, p)] = None
        elif spec[0] == "d":
            out[(c, p)] = vals[(c, spec[1])]
        else:
            _, k1, k2, frac = spec
            a, b = vals[(c, k1)], vals[(c, k2)]
            out[(c, p)] = a if k1 == k2 else a + (b - a) * frac
    return out


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   method: str = "disc") -> DataFrame:
    """Long table ``(column, p, value)`` of exact quantiles (size cols x probs)."""
    q = exact_quantiles(df, cols, probs, method)
    rows = [(c, float(p), None if q[(c, p)] is None else float(q[(c, p)]))
            for c in cols for p in probs]
    schema = T.StructType([T.StructField("column", T.StringType()),
                           T.StructField("p", T.DoubleType()),
                           T.StructField("value", T.DoubleType())])
    return df.sparkSession.createDataFrame(rows, schema)
