"""Quality rules: base counts, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word unigrams and bigrams are counted over all documents:
one over the trusted target (labelled good), one over the raw corpus.  A document's
score is the mean log-likelihood ratio of its n-grams.  Both sides have ``PRIOR`` pseudo-counts per bucket
at the raw corpus' rate, and a target count that chance explains, or that is within a factor of two of the
expected one, scores 0: the mix of languages and copies moves many n-grams a little, and in long
documents those small ratios would outweigh the few words that the target never holds.  A document's own n-grams are taken out of the
counts before it is scored (leave one out), so labelled documents do not vouch for
themselves.  Every document is kept or not by one threshold, chosen on the scores of all labelled documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grams as G
from . import words as W
from .graph import saved

UNIGRAMS, BIGRAMS = 1 << 20, 1 << 17
BUCKETS = UNIGRAMS + BIGRAMS
PRIOR = 0.5               # counts: a word's absence from the target must tell in small tables too
SIGMA = 2.0               # deviations from the expected target count below this many are chance
LEAST = math.log(2)       # ratios nearer to 0 than this count as 0
MAX_LOST = 0.02           # share of the labelled good documents that the threshold may drop
BINS = 4000               # of the score histogram that sets the threshold
SPAN = 4.0                # scores are cut to -SPAN..SPAN for the histogram
LABEL_ROWS = 2_000_000    # distinct labelled ids (about 20 bytes each) up to which labels are broadcast

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def base_counts(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The five base counts of every row of a text buffer."""
    n = len(offsets) - 1
    words, first = W.hash_words(raw, offsets, lower=False)

    def per_row(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum(mask, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    lines, repeats = np.zeros(n, np.int64), np.zeros(n, np.int64)
    triples = W.shingle_hashes(words, 3)
    for i in range(n):
        seen: set[bytes] = set()
        for line in raw[offsets[i]:offsets[i + 1]].tobytes().split(b"\n"):
            if line in seen:
                lines[i] += 1
            elif line.strip(b"\t\x0b\x0c\r "):
                seen.add(line)
        a, b = first[i], first[i + 1]
        if b - a >= 4:
            own = triples[a:b - 2]
            order = np.argsort(own, kind="stable")
            ranked = own[order]
            twin = np.zeros(len(own) + 1, dtype=bool)
            twin[1:-1] = ranked[1:] == ranked[:-1]
            again = np.zeros(b - a, dtype=bool)
            hit = order[twin[1:] | twin[:-1]]
            for k in range(3):
                again[hit + k] = True
            repeats[i] = again.sum()
    return {"n_words": np.diff(first).astype(np.int64),
            "word_chars": per_row(~W.SEPARATOR[raw] & ((raw & 0xC0) != 0x80)),
            "n_symbols": per_row(_SYMBOL[raw]), "n_dup_lines": lines, "n_repeat_words": repeats}


def _buckets(raw: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Bucket and row bounds of the unigrams and of the bigrams, and n-grams per row."""
    words, first = W.hash_words(raw, offsets)
    pairs, at = G.bigram_hashes(words, first)
    one, two = (words & np.uint64(UNIGRAMS - 1)), (pairs & np.uint64(BIGRAMS - 1)) + np.uint64(UNIGRAMS)
    parts = [(one.astype(np.int64), first), (two.astype(np.int64), np.searchsorted(at, first))]
    return parts, sum(np.diff(f) for _, f in parts)


def _scores(parts: list, n: np.ndarray, good: np.ndarray, every: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Mean log-likelihood ratio of every row's n-grams, its own counts left out."""
    rows = np.arange(len(n))
    code = np.concatenate([np.repeat(rows, np.diff(first)) * BUCKETS + bucket for bucket, first in parts])
    code, count = np.unique(code, return_counts=True)
    row, bucket = code // BUCKETS, code % BUCKETS
    rate = (target.sum() - n * good) / np.maximum(every.sum() - n, 1)
    seen, expected = target[bucket] - count * good[row], (every[bucket] - count) * rate[row]
    ratio = np.log((seen + PRIOR) / (expected + PRIOR))
    ratio[(np.abs(seen - expected) <= SIGMA * np.sqrt(expected + 1)) | (np.abs(ratio) < LEAST)] = 0.0
    total = np.bincount(row, weights=ratio * count, minlength=len(n))
    return np.round(total / np.maximum(n, 1), 9)


def _count(batches):
    """Per task: n-grams per bucket in all rows and in target rows."""
    every, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        raw, offsets = W.text_buffer(batch.column("text"))
        chosen = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
        for i, j in W.row_chunks(offsets):
            parts, _ = _buckets(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            for bucket, first in parts:
                every += np.bincount(bucket, minlength=BUCKETS)
                own = np.repeat(chosen[i:j], np.diff(first))
                target += np.bincount(bucket[own], minlength=BUCKETS)
    used = np.flatnonzero(every)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(every[used]), pa.array(target[used])], ["bucket", "every", "target"])


def bucket_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """n-grams per bucket in all and in target rows, from (text, target); a fixed 18 MB on the driver."""
    counts = docs.mapInArrow(_count, "bucket int, every long, target long").groupBy("bucket").agg(
        F.sum("every").alias("every"), F.sum("target").alias("target")).toArrow()
    every, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = counts["bucket"].to_numpy()
    every[at], target[at] = counts["every"].to_numpy(), counts["target"].to_numpy()
    return every, target


def label_table(labels: DataFrame, id_col: str) -> DataFrame:
    """One row per id: good = every label of it says quality 1 and not toxic.

    Labels with a NULL id or NULL quality are left out; NULL toxic counts as not toxic.
    """
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return (labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
            .groupBy(F.col(id_col).alias("label_id")).agg(F.min(good).alias("good")))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, good, base counts, score): ``good`` is NULL where a document has no label."""
    marks = label_table(labels, id_col)
    few = marks.count() <= LABEL_ROWS
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    joined = base.join(F.broadcast(marks) if few else marks, F.col("id") == F.col("label_id"), "left").select(
        "id", "text", "good")
    shared = docs.sparkSession.sparkContext.broadcast(
        bucket_counts(joined.select("text", F.coalesce("good", F.lit(False)).alias("target"))))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        every, target = shared.value
        for batch in batches:
            raw, offsets = W.text_buffer(batch.column("text"))
            good = batch.column("good").fill_null(False).to_numpy(zero_copy_only=False).astype(np.int64)
            out: dict[str, list[np.ndarray]] = {c: [] for c in [*names, "score"]}
            for i, j in W.row_chunks(offsets):
                part, own = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                for c, v in base_counts(part, own).items():
                    out[c].append(v)
                parts, n = _buckets(part, own)
                out["score"].append(_scores(parts, n, good[i:j], every, target))
            cols = [np.concatenate(v) if v else np.zeros(0, np.float64 if c == "score" else np.int64)
                    for c, v in out.items()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("good"), *map(pa.array, cols)],
                                             ["id", "good", *out])

    kind = base.schema["id"].dataType.simpleString()
    return joined.mapInArrow(run, f"id {kind}, good boolean, " + ", ".join(f"{c} long" for c in names)
                             + ", score double")


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def choose_threshold(scored: DataFrame, max_lost: float = MAX_LOST) -> float:
    """The highest histogram edge that drops at most ``max_lost`` of the labelled good rows
    among those that pass the base rules.  Without both kinds of labels nothing is dropped.
    """
    bin_ = F.floor((F.least(F.greatest("score", F.lit(-SPAN)), F.lit(SPAN - 1e-9)) + SPAN) * (BINS / (2 * SPAN)))
    rows = (scored.where(F.col("good").isNotNull() & ~base_failed()).groupBy(bin_.cast("int").alias("bin"))
            .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).collect())
    good = np.zeros(BINS + 1)
    for r in rows:
        good[r["bin"] + 1] = r["good"]
    if not good.sum() or not any(r["bad"] for r in rows):
        return -np.inf
    best = int(np.flatnonzero(np.cumsum(good) <= max_lost * good.sum())[-1])
    return -SPAN + best * (2 * SPAN / BINS) if best else -np.inf


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, the five base counts, base_failed, kept, score, threshold), one row per input row.

    NULL or empty text has no words and fails the base rules.  A document is kept
    if it passes them and its score is not below the threshold.  Repeated rows get equal verdicts.
    Without labels no document is dropped by the score.  Columns of the documents other than id and text
    are ignored; an empty table gives an empty result.
    """
    scored = saved(quality_scores(docs, labels, id_col, text_col))
    threshold = choose_threshold(scored)
    return (scored.withColumn("base_failed", base_failed())
            .withColumn("threshold", F.lit(float(threshold)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.col("threshold")))
            .withColumnRenamed("id", id_col).drop("good"))
