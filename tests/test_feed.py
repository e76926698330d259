import math
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskwise.operators import feed as FD
from riskwise.operators import split as SP


def _events(n=3000, seed=5):
    rnd = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", "c"])  # one feed holds most rows
        ts = t0 + timedelta(seconds=rnd.randint(0, 5 * 86400))
        if i % 7 == 0:  # duplicate timestamps: ties broken by id
            ts = t0 + timedelta(hours=3)
        rows.append((i, ts, key, rnd.randint(0, 1)))
    rnd.shuffle(rows)  # arrival order is not event order
    return rows


@pytest.mark.parametrize("slice_rows", [7, 100, 1_000_000])     # slices shorter than a window, several, none
def test_rolling_rate_matches_brute_force(spark, slice_rows):
    rows = _events()
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, feed string, flag int")
    got = {r["event_id"]: (r["n_window"], r["n_pos"])
           for r in FD.rolling_rate(df, "feed", "ts", "event_id", "flag", n=20, rows_per_slice=slice_rows).collect()}
    pdf = pd.DataFrame(rows, columns=["event_id", "ts", "feed", "flag"]).sort_values(["feed", "ts", "event_id"])
    for _, g in pdf.groupby("feed"):
        flags = g["flag"].tolist()
        for i, eid in enumerate(g["event_id"].tolist()):
            lo = max(0, i - 19)
            assert got[eid] == (i - lo + 1, sum(flags[lo:i + 1]))


def test_newest_per_key_and_timeline(spark):
    rows = _events(500)
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, feed string, flag int")
    nw = FD.newest_per_key(df, "feed", "ts", "event_id", 20).collect()
    pdf = pd.DataFrame(rows, columns=["event_id", "ts", "feed", "flag"])
    for key, g in pdf.groupby("feed"):
        want = g.sort_values(["ts", "event_id"], ascending=False)["event_id"].head(20).tolist()
        have = [r["event_id"] for r in sorted((r for r in nw if r["feed"] == key), key=lambda r: r["position"])]
        assert have == want
    tl = FD.timeline(df, "ts", "event_id", 20).orderBy("step").collect()
    assert [r["event_id"] for r in tl] == \
        pdf.sort_values(["ts", "event_id"]).tail(20)["event_id"].tolist()


def test_stratified_split_small_classes(spark):
    # classes of one to three rows, a NULL class, no test rows at all, all rows for the test
    rows = [(i, c) for i, c in enumerate([0] * 50 + [1] * 3 + [2] * 2 + [3] + [None] * 4)]
    df = spark.createDataFrame(rows, "id long, label int")
    for frac in (0.0, 0.2, 0.5, 1.0):
        got = {}
        for r in SP.stratified_split(df, "label", ["id"], ["id"], frac).collect():
            got.setdefault(r["label"], []).append(r["split"])
        assert {v: x.count("test") for v, x in got.items()} == {
            v: math.ceil(frac * n) for v, n in ((0, 50), (1, 3), (2, 2), (3, 1))} | {None: 0}
    assert SP.stratified_split(df.limit(0), "label", ["id"], ["id"], 0.2).count() == 0


def test_folds_disjoint_and_covering(spark):
    df = spark.range(0, 5000).withColumn("label", (F.col("id") % 3 == 0).cast("int"))
    f = SP.fold_assign(df, ["id"], 3)
    counts = {r["fold"]: r["count"] for r in f.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2} and sum(counts.values()) == 5000
    assert f.select("id").distinct().count() == 5000


def test_stratified_split_exact_counts(spark):
    # duplicate keys make hash ties: the tie rows are ranked by the tie columns
    df = spark.range(0, 3000).withColumn("key", F.col("id") % 700) \
        .withColumn("label", (F.col("id") % 4 == 0).cast("int"))
    s = SP.stratified_split(df, "label", ["key"], ["id"], 0.2)
    got = {(r["label"], r["split"]): r["count"] for r in s.groupBy("label", "split").count().collect()}
    n1, n0 = 750, 2250
    assert got[(1, "test")] == 150 and got[(0, "test")] == 450
    assert got[(1, "train")] == n1 - 150 and got[(0, "train")] == n0 - 450
    assert s.count() == 3000


def test_rolling_rate_keeps_null_keys_and_times(spark):
    rows = [(1, None, "a", 1), (2, datetime(2024, 1, 1), "a", 0), (3, datetime(2024, 1, 2), None, 1),
            (4, datetime(2024, 1, 3), None, 1), (5, None, None, 0)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, feed string, flag int")
    got = {r["event_id"]: (r["n_window"], r["n_pos"])
           for r in FD.rolling_rate(df, "feed", "ts", "event_id", "flag", n=20).collect()}
    # NULL times first within a feed; the NULL feed is a feed of its own
    assert got == {1: (1, 1), 2: (2, 1), 5: (1, 0), 3: (2, 1), 4: (3, 2)}


def test_quantiles_ignore_nan(spark):
    from riskwise.operators import quantiles as Q
    df = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,), (None,), (3.0,)], "x double")
    assert Q.exact_quantiles(df, ["x"], [0.5])[("x", 0.5)] == 2.0


@pytest.mark.parametrize("ranked_rows", [1_000_000, 10])     # ranked in one window; cut by k-th values and quotas
def test_stratified_split_hot_key_and_copies(spark, ranked_rows):
    # one key holds a third of all rows, and half of those are identical copies
    hot = spark.range(0, 1000).select(F.lit(7).alias("key"), F.lit(1).alias("label"),
                                      F.when(F.col("id") < 500, F.lit(-1)).otherwise(F.col("id")).alias("v"))
    rest = spark.range(0, 2000).select((F.col("id") % 900 + 100).alias("key"),
                                       (F.col("id") % 2).cast("int").alias("label"), F.col("id").alias("v"))
    df = hot.unionByName(rest).repartition(7)
    s = SP.stratified_split(df, "label", ["key"], ["key", "label", "v"], 0.2, ranked_rows=ranked_rows)
    got = {(r["label"], r["split"]): r["count"] for r in s.groupBy("label", "split").count().collect()}
    n1, n0 = 1000 + 1000, 1000
    assert got[(1, "test")] == 400 and got[(0, "test")] == 200
    assert got[(1, "train")] == n1 - 400 and got[(0, "train")] == n0 - 200
    # the same rows as the row_number cut (copies are interchangeable)
    from pyspark.sql import Window as W
    ordered = df.withColumn("h", SP.key_hash(["key"])).withColumn("h2", SP.key_hash(["key", "label", "v"], 13)) \
        .withColumn("rn", F.row_number().over(W.partitionBy("label").orderBy("h", "h2")))
    need = {1: 400, 0: 200}
    want = sorted((r["label"], r["key"], r["v"]) for r in ordered.collect() if r["rn"] <= need[r["label"]])
    have = sorted((r["label"], r["key"], r["v"]) for r in s.where("split = 'test'").collect())
    assert have == want


def _brute_rate(rows, n):
    out, feeds = {}, {}
    for r in rows:
        feeds.setdefault(r[2], []).append(r)
    for feed in feeds.values():
        feed.sort(key=lambda r: (r[1] is not None, r[1] or datetime.min, r[0]))
        for i, r in enumerate(feed):
            w = feed[max(0, i - n + 1):i + 1]
            out[r[0]] = (len(w), sum(x[3] or 0 for x in w))
    return out


@pytest.mark.parametrize("n", [1, 5, 20])
def test_rolling_rate_of_bursts_is_spread_and_exact(spark, n):
    # one feed within a single second, one without any time, one NULL feed, one spread out with a burst in it
    t0, rnd = datetime(2024, 1, 1), random.Random(n)
    rows = [(i, t0, "second", rnd.randint(0, 1)) for i in range(0, 1500)]
    rows += [(i, None, "timeless", rnd.choice([0, 1, None])) for i in range(1500, 2300)]
    rows += [(i, t0 + timedelta(microseconds=rnd.randint(0, 3)), None, 1) for i in range(2300, 3000)]
    rows += [(i, t0 + timedelta(days=rnd.randint(0, 300)) if i % 2 else t0 + timedelta(hours=5), "mixed", rnd.randint(0, 1))
             for i in range(3000, 4000)]
    rows += [(i, t0, f"small{i % 7}", 1) for i in range(4000, 4030)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, feed string, flag int")
    got = FD.rolling_rate(df, "feed", "ts", "event_id", "flag", n=n, rows_per_slice=60)
    assert {r["event_id"]: (r["n_window"], r["n_pos"]) for r in got.collect()} == _brute_rate(rows, n)
    cut, many = FD._sliced(df, ["feed"], "ts", "event_id", 60)
    sizes = cut.groupBy("feed", "__sid").count()
    assert many and sizes.agg(F.max("count")).first()[0] <= 300
    assert cut.count() == len(rows)
    assert sizes.where("feed = 'second'").count() >= 10 and sizes.where("feed = 'timeless'").count() >= 6


def test_halo_adds_little_and_rows_are_shuffled_once(spark):
    df = spark.range(5000).selectExpr("id AS event_id", "timestamp_ntz '2024-01-01' + make_interval(0,0,0,0,0,0,id) AS ts", "'a' AS feed", "1 AS flag")
    rows, _ = FD._sliced(df, ["feed"], "ts", "event_id", 500)
    slices = rows.select("__sid").distinct().count()
    assert FD._halo(rows, ["feed"], "ts", "event_id", 19).count() == 19 * (slices - 1)
    two = FD.rolling_rate(df, ["feed", "flag"], "ts", "event_id", "flag", rows_per_slice=500, also={"ids": F.col("event_id")})
    assert two.agg(F.sum("ids")).first()[0] == sum(sum(range(max(0, i - 19), i + 1)) for i in range(5000))
