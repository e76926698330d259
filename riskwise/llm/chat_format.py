"""Chat formatting with perspective rotation.

For every participant of a conversation the dialogue is rendered once with that
speaker as ``assistant`` and all others as named users; the mask spans cover what the
speaker says.  A conversation is rendered in parts of ``PART`` consecutive turn numbers, and
an over-full part is cut into its single turn numbers, an over-full turn number by row hash, so no group
holds a whole long conversation.  All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import saved

PART = 256                # turn numbers per rendered part
PART_ROWS = 1024          # rows per part beyond which it is cut
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def header(speaker: Column, perspective: Column) -> Column:
    return F.when(speaker == "system", F.lit(OPEN + "system\n")).when(
        speaker == perspective, F.lit(OPEN + "assistant\n")).otherwise(
        F.concat(F.lit(OPEN + "user name="), speaker, F.lit("\n")))


def _cut(rows: DataFrame, keys: list[str], name: str, value: Column) -> DataFrame:
    """Column ``name``: ``value`` in groups of more than PART_ROWS rows, else 0."""
    over = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("long").alias("cuts")).where("cuts > 1")
    over = over.withColumnsRenamed({k: f"over_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"over_{k}"))
    return (rows.join(over, same, "left")
            .withColumn(name, F.when(F.col("cuts").isNull(), 0).otherwise(value).cast("long"))
            .drop("cuts", *[f"over_{k}" for k in keys]))


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
                        text_col: str = "text") -> DataFrame:
    """(``conv_col``, perspective, part, fine, cut, n_turns, n_rows, text, mask).

    One row per conversation, participant and part; (part, fine, cut) orders the parts.
    ``mask`` is an array of [start, end) code-point spans of ``text`` that hold the participant's
    own words with their end mark.  Turns are ordered by number, then speaker and text; NULL turn numbers come
    last.  Repeated rows (equal in all four columns) are one turn and counted in ``n_rows``.  A NULL speaker is
    called ``unknown``; a NULL text is empty; rows with a NULL conversation form one conversation of NULL id.
    ``system`` is not a participant.  Other columns are ignored; an empty table gives an empty result.
    """
    base = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(speaker_col).cast("string"), F.lit("unknown")).alias("speaker"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = saved(base.groupBy("conv", "turn", "speaker", "text").agg(F.count(F.lit(1)).alias("copies"))
                 .withColumn("part", F.floor(F.col("turn") / PART)))
    speakers = rows.where("speaker <> 'system'").select(F.col("conv").alias("c"), F.col("speaker").alias("perspective")).distinct()
    rows = _cut(rows, ["conv", "part"], "fine", F.coalesce("turn", F.lit(0)))
    rows = _cut(rows, ["conv", "part", "fine"], "cut", F.pmod(F.xxhash64("speaker", "text"), F.col("cuts")))
    parts = rows.groupBy("conv", "part", "fine", "cut").agg(
        F.sort_array(F.collect_list(F.struct(
            F.col("turn").isNull().alias("last"), "turn", "speaker", "text", "copies"))).alias("turns"))
    joined = parts.join(speakers, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    who = F.col("perspective")
    pieces = F.transform("turns", lambda t: F.struct(
        header(t["speaker"], who).alias("head"), F.concat(t["text"], F.lit(CLOSE)).alias("body"),
        (t["speaker"] == who).alias("own")))
    done = joined.withColumn("pieces", pieces)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        a = acc["at"] + F.length(p["head"])
        b = a + F.length(p["body"])
        return F.struct(b.alias("at"), F.when(p["own"], F.array_append(
            acc["spans"], F.struct(a.alias("start"), b.alias("end")))).otherwise(acc["spans"]).alias("spans"))

    return done.select(
        F.col("conv").alias(conv_col), "perspective", "part", "fine", "cut",
        F.size("turns").cast("long").alias("n_turns"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["copies"]).alias("n_rows"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
        F.aggregate("pieces", start, step, lambda acc: acc["spans"]).alias("mask"))
