"""Streams over several micro-batches must equal the batch operators."""

import pytest
from pyspark.sql import functions as F

from riskwise import roles
from riskwise.operators import feed as FD
from riskwise.session import scratch_path, table
from riskwise.streaming import feed as ST

from .conftest import SF_SMALL


def _landing(spark, parts=4, reverse=False):
    """The event table cut into ``parts`` files by event time, in a landing folder."""
    ev = table(spark, SF_SMALL, "events")
    folder = scratch_path(spark, "landing")
    edges = ev.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")),
                                       [i / parts for i in range(1, parts)], 10000)).first()[0]
    bounds = [None] + list(edges) + [None]
    # the file source takes files in modification order: write the newest slice first to make
    # every later micro-batch late
    for i in (reversed(range(parts)) if reverse else range(parts)):
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        cond = F.lit(True)
        if bounds[i] is not None:
            cond = cond & (us >= bounds[i])
        if bounds[i + 1] is not None:
            cond = cond & (us < bounds[i + 1])
        ev.where(cond).coalesce(1).write.parquet(f"{folder}/part{i}")
    return ev, folder


def _source(spark, folder):
    return (spark.readStream.schema(ST.EVENT_SCHEMA).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(folder))


def test_last_n_and_trend_across_batches(spark):
    ev, folder = _landing(spark)
    scorer = FD.FeedScorer.fit(ev)
    batch_scored = scorer.transform(ev).withColumnRenamed(roles.FEED_KEY, "feed_key")

    sink = ST.last_n_stream(spark, _source(spark, folder), scorer)
    got = {r["event_id"]: (r["n_window"], r["n_pos"]) for r in ST.read_last_n(spark, sink).collect()}
    want = {r["event_id"]: (r["n_window"], r["n_pos"]) for r in
            FD.rolling_rate(batch_scored, "feed_key", "ts", "event_id", "prediction").collect()}
    assert got == want

    tsink = ST.trend_stream(spark, _source(spark, folder), scorer)
    log = spark.read.parquet(f"{tsink}/rows")
    assert log.select("epoch").distinct().count() > 1  # really several micro-batches
    trend = {(r["window_start"], r["feed_key"]): (r["n"], r["avg_risk_pct"])
             for r in ST.read_trend(spark, tsink).collect()}
    want_t = {(r["d"], r["feed_key"]): (r["n"], r["a"]) for r in
              batch_scored.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("d"), "feed_key")
              .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("risk_pct"), 6).alias("a")).collect()}
    assert set(trend) == set(want_t)
    for k, (n, a) in want_t.items():
        assert trend[k][0] == n and abs(trend[k][1] - a) < 1e-6


def test_last_n_with_late_batches(spark):
    """Batches arrive newest first: every later batch is late and revises rows."""
    ev, folder = _landing(spark, 3, reverse=True)
    scorer = FD.FeedScorer.fit(ev)
    batch_scored = scorer.transform(ev).withColumnRenamed(roles.FEED_KEY, "feed_key")
    sink = ST.last_n_stream(spark, _source(spark, folder), scorer)
    assert spark.read.parquet(f"{sink}/rates").count() > ev.count()  # late records revised earlier rows
    trend = ST.read_trend(spark, ST.trend_stream(spark, _source(spark, folder), scorer))
    assert trend.agg(F.sum("n")).first()[0] == ev.count()
    got = {r["event_id"]: (r["n_window"], r["n_pos"], r["pos_rate"]) for r in ST.read_last_n(spark, sink).collect()}
    want = {r["event_id"]: (r["n_window"], r["n_pos"], r["pos_rate"]) for r in
            FD.rolling_rate(batch_scored, "feed_key", "ts", "event_id", "prediction").collect()}
    assert got == want


def test_repeated_ids_and_missing_times_equal_batch(spark):
    ev = table(spark, SF_SMALL, "events")
    odd = ev.limit(40).unionByName(ev.limit(10)).withColumn(
        "ts", F.expr("if(event_id % 7 = 0, cast(null as timestamp_ntz), ts)")).withColumn("event_id", F.expr("event_id % 5"))
    folder = scratch_path(spark, "landing")
    for i in (2, 0, 1):
        odd.where(F.pmod(F.xxhash64("ts", "value"), F.lit(3)) == i).coalesce(1).write.parquet(f"{folder}/part{i}")
    scorer = FD.FeedScorer.fit(ev)
    stored = spark.read.parquet(*[f"{folder}/part{i}" for i in range(3)])
    want = FD.rolling_rate(scorer.transform(stored).withColumnRenamed(roles.FEED_KEY, "feed_key"),
                           "feed_key", "ts", "event_id", "prediction")
    got = ST.read_last_n(spark, ST.last_n_stream(spark, ST.event_source(spark, folder), scorer))
    assert sorted(r["n_window"] for r in got.collect()) == sorted(r["n_window"] for r in want.collect())
    assert got.count() == 50


def _many_files(spark, n, order):
    """The events in ``n`` files, by time or shuffled, in the order that the file source takes them."""
    ev = table(spark, SF_SMALL, "events")
    folder = scratch_path(spark, "landing")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = ev.agg(F.min(us), F.max(us)).first()
    slot = F.least(F.floor((us - lo) * n / (hi - lo + 1)), F.lit(n - 1)) if order == "time" else F.pmod(F.xxhash64("event_id"), F.lit(n))
    rows = {}
    for r in ev.withColumn("slot", slot).collect():
        rows.setdefault(r["slot"], []).append(r[:6])
    for k in sorted(rows, key=lambda k: k if order == "time" else (k * 7) % n):
        spark.createDataFrame(rows[k], ev.schema).coalesce(1).write.parquet(f"{folder}/part{k}")
    return ev, folder, len(rows)


@pytest.mark.parametrize("order", ["time", "shuffled"])
def test_history_reads_do_not_grow_with_the_epochs(spark, order):
    ev, folder, epochs = _many_files(spark, 34, order)
    assert epochs > 30
    scorer, progress = FD.FeedScorer.fit(ev), []
    sink = ST.last_n_stream(spark, _source(spark, folder), scorer, compact_every=4, progress=progress)
    want = FD.rolling_rate(scorer.transform(ev).withColumnRenamed(roles.FEED_KEY, "feed_key"), "feed_key", "ts", "event_id", "prediction")
    key = lambda df: sorted((r["event_id"], r["n_window"], r["n_pos"], r["pos_rate"]) for r in df.collect())
    assert key(ST.read_last_n(spark, sink)) == key(want)
    assert [p["epoch"] for p in progress] == list(range(epochs))
    folders = [p["folders"] for p in progress]
    buckets = ev.select(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 86400)).distinct().count()
    assert max(folders) <= buckets * 4               # a base and three parts of a bucket at most
    if order == "time":                              # neighbours only
        assert max(folders[16:]) <= max(folders[4:16]) + 4 and max(folders) < buckets


def test_trend_with_a_tight_watermark_counts_late_rows(spark):
    ev, folder, _ = _many_files(spark, 9, "shuffled")
    scorer = FD.FeedScorer.fit(ev)
    want = {(r["d"], r["feed_key"]): (r["n"], r["a"]) for r in
            scorer.transform(ev).withColumnRenamed(roles.FEED_KEY, "feed_key")
            .groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("d"), "feed_key")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("risk_pct"), 6).alias("a")).collect()}
    sink = ST.trend_stream(spark, _source(spark, folder), scorer, delay="0 seconds", compact_every=4)
    rows = spark.read.parquet(f"{sink}/rows")
    assert rows.where("late").count() > 0 and rows.where("not late").count() > 0
    assert [r["epoch"] for r in spark.read.parquet(f"{sink}/base").select("epoch").distinct().collect()]
    got = {(r["window_start"], r["feed_key"]): (r["n"], r["avg_risk_pct"]) for r in ST.read_trend(spark, sink).collect()}
    assert set(got) == set(want)
    assert all(got[k][0] == n and abs(got[k][1] - a) < 1e-6 for k, (n, a) in want.items())


def test_streams_over_nothing(spark):
    ev = table(spark, SF_SMALL, "events")
    folder = scratch_path(spark, "landing")
    ev.limit(0).coalesce(1).write.parquet(f"{folder}/part0")
    scorer = FD.FeedScorer.fit(ev)
    assert ST.read_last_n(spark, ST.last_n_stream(spark, _source(spark, folder), scorer)).count() == 0
    assert ST.read_trend(spark, ST.trend_stream(spark, _source(spark, folder), scorer)).count() == 0
