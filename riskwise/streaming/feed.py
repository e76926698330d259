"""Structured Streaming feed.

* ``score_stream``   - T1/T2: stateless clean + clip + score of every arriving record.
* ``last_n_stream``  - T3: per-feed last-N history with the positive rate.  Every
  micro-batch runs the sliced batch operator over its own records and their neighbours in
  the stored buckets, so late records are placed by event time, however late.
* ``trend_stream``   - T4: totals of open event-time windows in the state store, under a watermark;
  records later than that become late rows, which readers add, so none is too late to count.

All sinks and checkpoints live in the shared folder; every sink write is
idempotent per epoch, so a restarted query (or a lost executor) replays safely.
No result depends on how records are dealt to files or in which order they arrive.
"""

from __future__ import annotations

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from riskwise import roles
from riskwise.operators.feed import FeedScorer, rolling_rate, with_k
from riskwise.operators.quarantine import Check, scored
from riskwise.session import saved, scratch_path

EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                "value double, props string")


def event_source(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """File stream of event records with a declared schema (no inference).

    ``path`` is a table as the batch reader takes it: one file or a folder of part
    files.  New files become micro-batches; ``maxFilesPerTrigger`` bounds the size of one.
    """
    return (spark.readStream.schema(EVENT_SCHEMA)
            .option("maxFilesPerTrigger", files_per_trigger)
            .option("recursiveFileLookup", "true").parquet(path))


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover
        raise query.exception()


def score_stream(spark: SparkSession, source: DataFrame, scorer: FeedScorer, sink: str | None = None) -> str:
    """Score every record; append to a parquet sink (exactly-once file sink)."""
    out = scorer.transform(source).select(
        F.col(roles.FEED_ID), F.col(roles.FEED_KEY).alias("feed_key"), F.col(roles.FEED_TIME).alias("event_time"),
        "tag", "clock", "value", "k", "risk_pct", "diagnosis", "prediction")
    return append_stream(spark, out, "feed-scored", sink)


def append_stream(spark: SparkSession, rows: DataFrame, name: str, sink: str | None = None,
                  partition_by: tuple = ()) -> str:
    """Append a stateless stream to a parquet sink until its source is drained (exactly-once file sink)."""
    sink = sink or scratch_path(spark, name)
    _run(rows.writeStream.format("parquet").option("path", sink).partitionBy(*partition_by)
         .option("checkpointLocation", sink + "-ckpt").trigger(availableNow=True).start())
    return sink


FEED_CHECK = Check(T.StructType([T.StructField(roles.FEED_ID, T.LongType()), T.StructField(roles.FEED_TIME, T.TimestampNTZType())]
                                + [T.StructField(c, T.DoubleType()) for c in roles.FEED_FEATURES]))


def score_stream_checked(spark: SparkSession, source: DataFrame, scorer: FeedScorer, check: Check = FEED_CHECK,
                         sink: str | None = None) -> str:
    """T1 + M2: score every record that passes the check; the others go, as entered and with their reasons, to the
    folder ``accepted=false`` of the same exactly-once sink.  No record ends the stream, and a replayed
    epoch writes both parts again or neither."""
    def score(rows: DataFrame) -> DataFrame:
        out = scorer.transform(rows, extract=False)
        return out.select("kept", "prediction", "p", "risk_pct", "diagnosis", "tag", "clock")

    rows = scored(with_k(source), check, score, ["prediction", "p", "risk_pct", "diagnosis", "tag", "clock"],
                  [roles.FEED_ID, roles.FEED_KEY, roles.FEED_TIME])
    return append_stream(spark, rows, "feed-checked", sink, ("accepted",))


RECORDS = "event_id long, feed_key string, ts timestamp_ntz, prediction int, us long, arrived long, rid long, bucket long"
INDEX = "feed_key string, bucket long, n long, base long, parts array<long>"
RATES = "event_id long, feed_key string, ts timestamp_ntz, prediction int, arrived long, rid long, n_window long, n_pos long, pos_rate double"
_FIRST = -(2 ** 63)  # a record without an event time comes before all others of its feed
BUCKET_SECONDS = 86_400
FILE_ROWS = 1_000_000     # records that one task writes of a bucket
COMPACT_EVERY = 8         # micro-batches after which the buckets they touched are put together again


def _log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema + ", epoch long").parquet(path)


def _epochs(spark: SparkSession, path: str) -> list[int]:
    """Micro-batches that a log holds, from the names of its folders; none if there is no log yet."""
    try:
        found = spark.read.schema("epoch long").parquet(path).select("epoch").distinct().collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r["epoch"] for r in found)


class History:
    """The records of all feeds by event-time bucket, and the windows that each micro-batch changes.

    A record changes its own window and those of the ``n - 1`` records of its feed after it.  So a micro-batch needs, of
    the stored records, only the buckets of each feed that hold the ``n - 1`` records before and after a new one.  Which these are
    is read from the index: one row per feed and bucket with its number of records and the folders that hold
    them.  Exactly those folders are read.

    Folders below ``path``: ``records/epoch=E/bucket=B`` as they arrive; ``base/epoch=E/bucket=B``, all records of a
    bucket up to E, written every ``COMPACT_EVERY`` micro-batches for the buckets touched since; ``index/epoch=E``, the
    index after E; ``rates/epoch=E``, the windows that E changed.  A bucket is at most one base and
    ``COMPACT_EVERY`` parts, however many micro-batches there have been.  A micro-batch that is run again reads what was there
    before it and writes the same folders again.
    """

    def __init__(self, spark: SparkSession, path: str, n: int, bucket_seconds: int, compact_every: int):
        self.path, self.n, self.width, self.every = path, n, bucket_seconds * 1_000_000, compact_every
        self.done = _epochs(spark, f"{path}/index")
        self.read: list[dict] = []      # what every micro-batch read: epoch, folders, files

    def _read(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], RECORDS)
        kept = RECORDS.rsplit(", ", 1)[0]                  # the bucket is in the folder's name
        rows = spark.read.schema(kept).parquet(*folders)
        return rows.withColumn("bucket", self._bucket())

    def _bucket(self):
        return F.floor(F.col("us") / F.lit(self.width)).cast("long")

    def _folders(self, index: DataFrame) -> list[str]:
        rows = index.groupBy("bucket").agg(F.max("base").alias("base"), F.array_distinct(
            F.flatten(F.collect_list("parts"))).alias("parts")).collect()    # one row per bucket
        base = [f"{self.path}/base/epoch={r['base']}/bucket={r['bucket']}" for r in rows if r["base"] >= 0]
        return base + [f"{self.path}/records/epoch={e}/bucket={r['bucket']}" for r in rows for e in r["parts"]]

    def _needed(self, index: DataFrame) -> DataFrame:
        """Buckets of each feed near a new record, those without a gap between them in one ``stretch``."""
        along = Window.partitionBy("feed_key").orderBy("bucket")
        upto = along.rowsBetween(Window.unboundedPreceding, 0)
        rest = along.rowsBetween(0, Window.unboundedFollowing)
        rows = index.withColumn("end", F.sum("n").over(upto)).withColumn("start", F.col("end") - F.col("n"))
        new = F.col("added") > 0
        rows = rows.withColumns({"next_new": F.min(F.when(new, F.col("start"))).over(rest),
                                 "last_new": F.max(F.when(new, F.col("end"))).over(upto)})
        near = F.coalesce(F.col("next_new") - F.col("end") < self.n - 1, F.lit(False)) | \
            F.coalesce(F.col("start") - F.col("last_new") < self.n - 1, F.lit(False))
        rows = rows.withColumn("near", near).withColumn("stretch", F.count_if(~near).over(upto))
        return rows.where("near").select("feed_key", "bucket", "base", "parts", "stretch")

    def add(self, batch: DataFrame, epoch: int) -> None:
        s = batch.sparkSession
        before = [e for e in self.done if e < epoch]
        (batch.withColumns({"arrived": F.lit(epoch).cast("long"), "rid": F.monotonically_increasing_id(), "bucket": self._bucket()})
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/records/epoch={epoch}"))
        new = s.read.schema(RECORDS).parquet(f"{self.path}/records/epoch={epoch}")
        added = new.groupBy("feed_key", "bucket").agg(F.count(F.lit(1)).alias("added"))
        known = (s.read.schema(INDEX).parquet(f"{self.path}/index/epoch={before[-1]}") if before
                 else s.createDataFrame([], INDEX))
        both = known.withColumn("added", F.lit(0).cast("long")).unionByName(added.select(
            "feed_key", "bucket", F.col("added").alias("n"), F.lit(-1).cast("long").alias("base"),
            F.array(F.lit(epoch).cast("long")).alias("parts"), "added"))
        index = saved(both.groupBy("feed_key", "bucket").agg(
            F.sum("n").alias("n"), F.max("base").alias("base"), F.flatten(F.collect_list("parts")).alias("parts"),
            F.sum("added").alias("added")))
        needed = self._needed(index)
        folders = [f for f in self._folders(needed) if f"/records/epoch={epoch}/" not in f]
        stored = self._read(s, folders)
        self.read.append({"epoch": epoch, "folders": len(folders), "files": len(stored.inputFiles()) if folders else 0})
        rows = stored.withColumn("new", F.lit(0)).unionByName(new.withColumn("new", F.lit(1)))
        stretch = needed.select(F.col("feed_key").alias("k"), F.col("bucket").alias("b"), "stretch")
        rows = rows.join(stretch, F.col("feed_key").eqNullSafe(F.col("k")) & (F.col("bucket") == F.col("b"))).drop("k", "b")
        rates = rolling_rate(rows, ["feed_key", "stretch"], "ts", "event_id", "prediction", self.n,
                             also={"n_new": F.col("new")}).where("n_new > 0")
        rates.select(*[f.split()[0] for f in RATES.split(", ")]).write.mode("overwrite").parquet(f"{self.path}/rates/epoch={epoch}")
        after = index.drop("added")
        if (epoch + 1) % self.every == 0:
            after = self._compacted(s, after, epoch)
        after.write.mode("overwrite").parquet(f"{self.path}/index/epoch={epoch}")
        self.done = [*before, epoch]

    def _compacted(self, spark: SparkSession, index: DataFrame, epoch: int) -> DataFrame:
        """The buckets that have parts, each written as one base."""
        touched = index.where(F.size("parts") > 0).select("bucket").distinct()
        rows = index.join(touched, "bucket", "left_semi")
        folders = self._folders(rows)
        if not folders:
            return index
        most = rows.groupBy("bucket").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
        spread = F.pmod(F.xxhash64("arrived", "rid"), F.lit(-(-most // FILE_ROWS)))     # a full bucket is several files
        (self._read(spark, folders).repartition("bucket", spread).write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{self.path}/base/epoch={epoch}"))
        done = touched.select(F.col("bucket").alias("b"))
        joined = index.join(done, F.col("bucket") == F.col("b"), "left")
        moved = F.col("b").isNotNull()
        return joined.withColumns({"base": F.when(moved, F.lit(epoch).cast("long")).otherwise(F.col("base")),
                                   "parts": F.when(moved, F.array().cast("array<long>")).otherwise(F.col("parts"))}).drop("b")


def last_n_stream(spark: SparkSession, source: DataFrame, scorer: FeedScorer, n: int = roles.FEED_HISTORY,
                  sink: str | None = None, bucket_seconds: int = BUCKET_SECONDS, compact_every: int = COMPACT_EVERY,
                  progress: list | None = None) -> str:
    """Rolling count and positive rate of every record over the last n of its feed.

    Late records are placed by event time, however late; repeated ids are records of their own.  See ``History`` for what a
    micro-batch reads; ``progress`` gets a line on that for each.  ``read_last_n`` takes each record from
    the last micro-batch that reached it.  The index has a row per feed and bucket with records and is read and
    written as a whole: choose ``bucket_seconds`` so that a bucket holds many records of most feeds.
    """
    sink = sink or scratch_path(spark, "feed-last-n")
    history = History(spark, sink, n, bucket_seconds, compact_every)
    rows = scorer.transform(source).select(
        F.col(roles.FEED_ID).alias("event_id"), F.col(roles.FEED_KEY).alias("feed_key"),
        F.col(roles.FEED_TIME).alias("ts"), "prediction",
        F.coalesce(F.unix_micros(F.col(roles.FEED_TIME).cast("timestamp")), F.lit(_FIRST)).alias("us"))
    _run(rows.writeStream.foreachBatch(history.add).option("checkpointLocation", sink + "-ckpt")
         .trigger(availableNow=True).start())
    if progress is not None:
        progress += history.read
    return sink


def read_last_n(spark: SparkSession, sink: str) -> DataFrame:
    """Every record's rolling values, from the last micro-batch that reached it."""
    if not _epochs(spark, f"{sink}/rates"):
        return spark.createDataFrame([], "event_id long, feed_key string, event_time timestamp_ntz, prediction int, "
                                         "n_window long, n_pos long, pos_rate double")
    values = F.struct("event_id", "feed_key", F.col("ts").alias("event_time"), "prediction", "n_window", "n_pos", "pos_rate")
    last = _log(spark, f"{sink}/rates", RATES).groupBy("arrived", "rid").agg(F.max_by(values, F.col("epoch")).alias("r"))
    return last.select("r.*")


TREND = "window_start timestamp, feed_key string, part int, late boolean, n long, sum_risk double"
_TREND_STATE = "start array<long>, n array<long>, sum_risk array<double>"
SALTS = 8                 # states that one feed is spread over


def _counted(width_ms: int):
    """Counts and sums of one part of a feed per window: in the state while the window is open, else as a late row."""
    def run(key, frames, state: GroupState):
        feed, part = key
        open_from = state.getCurrentWatermarkMs() - width_ms     # a window that begins later has not ended
        totals = {w: (int(n), float(x)) for w, n, x in zip(*state.get) if w > open_from} if state.exists else {}
        late, changed = {}, set()
        for pdf in frames:
            for w, risk in pdf.groupby("start")["risk_pct"]:
                kept = totals if w > open_from else late
                n, x = kept.get(w, (0, 0.0))
                kept[w] = n + len(risk), x + float(risk.fillna(0.0).sum())
                changed.add(w)
        state.update((list(totals), [n for n, _ in totals.values()], [x for _, x in totals.values()]))
        rows = [(w, w in late, *(late if w in late else totals)[w]) for w in sorted(changed)]
        yield pd.DataFrame({"window_start": pd.to_datetime([r[0] for r in rows], unit="ms", utc=True), "feed_key": feed,
                            "part": part, "late": [r[1] for r in rows], "n": [r[2] for r in rows], "sum_risk": [r[3] for r in rows]})
    return run


def trend_stream(spark: SparkSession, source: DataFrame, scorer: FeedScorer, window: str = "1 day",
                 delay: str = "2 days", sink: str | None = None, compact_every: int = COMPACT_EVERY) -> str:
    """T4: average risk and record count per (event-time window, feed).

    The counts and sums of open windows are kept in the state store, one state per feed and part.  A window closes when
    the watermark, ``delay`` behind the newest event time, has passed its end; the feed's next record then clears it
    from the state.  A record that arrives later still is not lost: it becomes a late row, and readers add
    late rows to the last totals of its window.  So the state is bounded by feeds and open windows, and the result is
    the batch's for any order of arrival.

    Every micro-batch writes the totals it changed and its late rows under ``epoch=<id>`` (overwrite of that folder
    only, so a replayed one rewrites the same files); every ``compact_every`` of them, all before are put
    together in one ``base``.  Records without an event time belong to no window.
    """
    sink = sink or scratch_path(spark, "feed-trend")
    rows = scorer.transform(source).select(
        F.col(roles.FEED_TIME).cast("timestamp").alias("et"), F.col(roles.FEED_KEY).alias("feed_key"), "risk_pct",
        F.pmod(F.xxhash64(roles.FEED_ID, roles.FEED_TIME), F.lit(SALTS)).cast("int").alias("part"))
    one = spark.range(1).select(F.window(F.timestamp_millis(F.lit(0)), window).alias("w"))
    width = one.select(F.unix_millis("w.end") - F.unix_millis("w.start")).first()[0]
    keyed = (rows.where("et is not null").withWatermark("et", delay)
             .withColumn("start", F.unix_millis(F.window("et", window)["start"])))
    totals = keyed.groupBy("feed_key", "part").applyInPandasWithState(
        _counted(width), TREND, _TREND_STATE, "update", GroupStateTimeout.NoTimeout)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/rows/epoch={epoch}")
        if (epoch + 1) % compact_every == 0:
            s = batch.sparkSession
            _merged_trend(_trend_rows(s, sink, epoch)).write.mode("overwrite").parquet(f"{sink}/base/epoch={epoch}")

    _run(totals.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", sink + "-ckpt")
         .trigger(availableNow=True).start())
    return sink


def _trend_rows(spark: SparkSession, sink: str, upto: int | None = None) -> DataFrame:
    """The newest base (before ``upto``) and the rows of the micro-batches after it, with their ``epoch``."""
    bases = [e for e in _epochs(spark, f"{sink}/base") if upto is None or e < upto]
    last = bases[-1] if bases else -1
    fresh = [e for e in _epochs(spark, f"{sink}/rows") if e > last and (upto is None or e <= upto)]
    folders = ([f"{sink}/base/epoch={last}"] if bases else []) + [f"{sink}/rows/epoch={e}" for e in fresh]
    out = spark.createDataFrame([], TREND + ", epoch long")
    for f in folders:
        out = out.unionByName(spark.read.schema(TREND).parquet(f).withColumn("epoch", F.lit(int(f.rsplit("=", 1)[1])).cast("long")))
    return out


def _merged_trend(rows: DataFrame) -> DataFrame:
    """Per (window, feed, part): the last totals of its state, and the sum of its late rows."""
    key = ["window_start", "feed_key", "part"]
    late = rows.where("late").groupBy(*key, "late").agg(F.sum("n").alias("n"), F.sum("sum_risk").alias("sum_risk"))
    last = rows.where("not late").groupBy(*key, "late").agg(F.max_by(F.struct("n", "sum_risk"), F.col("epoch")).alias("r"))
    return late.unionByName(last.select(*key, "late", "r.*"))


def read_trend(spark: SparkSession, sink: str) -> DataFrame:
    """Totals and late rows of all micro-batches per (window, feed)."""
    total = _merged_trend(_trend_rows(spark, sink)).groupBy("window_start", "feed_key").agg(
        F.sum("n").alias("n"), F.sum("sum_risk").alias("sum_risk"))
    return total.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "feed_key", "n",
                        F.round(F.col("sum_risk") / F.col("n"), 6).alias("avg_risk_pct"))
