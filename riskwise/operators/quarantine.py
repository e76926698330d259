"""Quarantine of records that scoring cannot use.

A ``Check`` says which type every field has and which fields may be missing because scoring fills them.  A
record that breaks it never ends a batch or a stream: it is kept, as entered, with one reason per field, next to
the accepted ones.  Everything is one projection of column expressions, so the same check runs on a table and
on a stream, and accepted plus rejected is always the input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING, ABSENT, NOT_FINITE, IS_NAN, MALFORMED = "missing", "no such field", "not finite", "NaN", "malformed line"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTION = (T.FloatType, T.DoubleType)


@dataclass(frozen=True)
class Check:
    """Fields with their types, those that may be missing, and the column that holds a malformed line as read.

    Fields in ``optional`` may be NULL, NaN or absent; text that is not of the type, and an infinite value, are
    rejected in any field.  ``allowed`` restricts fields to a set of values.
    """

    schema: T.StructType
    optional: tuple = ()
    allowed: tuple = ()                # (field, values) pairs
    corrupt: str = "_corrupt_record"

    def value(self, df: DataFrame, field: T.StructField) -> Column:
        """The field in its type; NULL where it does not fit."""
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType)
        raw, have = F.col(field.name), df.schema[field.name].dataType
        value = raw.try_cast(field.dataType)
        if isinstance(field.dataType, _WHOLE) and not isinstance(have, _WHOLE):
            number = raw.try_cast("double")           # '33.0' is a whole number, 33.5 is not cut off
            whole = F.when(number == F.floor(number), number.try_cast(field.dataType))
            value = F.coalesce(value, whole) if isinstance(have, T.StringType) else whole
        if isinstance(field.dataType, _FRACTION) and field.name in self.optional:
            value = F.nanvl(value, F.lit(None).cast(field.dataType))
        return value

    def reason(self, df: DataFrame, field: T.StructField) -> Column:
        """What is wrong with a field, or NULL."""
        name, needed = field.name, field.name not in self.optional
        if name not in df.columns:
            return F.lit(f"{name}: {ABSENT}") if needed else F.lit(None).cast("string")
        raw, have, value = F.col(name), df.schema[name].dataType, self.value(df, field)
        empty = raw.isNull() if not isinstance(have, T.StringType) else raw.isNull() | (F.trim(raw) == "")
        out = F.when(empty, F.lit(f"{name}: {MISSING}") if needed else F.lit(None).cast("string"))
        if isinstance(field.dataType, (*_FRACTION, *_WHOLE)) and not isinstance(have, _WHOLE):
            number = raw.try_cast("double")
            out = out.when(F.abs(number) == float("inf"), F.lit(f"{name}: {NOT_FINITE}"))
            out = out.when(F.isnan(number), F.lit(f"{name}: {IS_NAN}") if needed else F.lit(None).cast("string"))
        out = out.when(value.isNull(), F.lit(f"{name}: not {field.dataType.simpleString()}"))
        for other, values in self.allowed:
            if other == name:
                out = out.when(~value.isin(*values), F.lit(f"{name}: not one of {', '.join(map(str, values))}"))
        return out

    def reasons(self, df: DataFrame) -> Column:
        """Array of what is wrong with a record, in field order; empty for a good one."""
        found = [self.reason(df, f) for f in self.schema.fields]
        if self.corrupt in df.columns:
            found.insert(0, F.when(F.col(self.corrupt).isNotNull(), F.lit(MALFORMED)))
        return F.filter(F.array(*found), lambda x: x.isNotNull())


def checked(df: DataFrame, check: Check, keep: Sequence[str] = ()) -> DataFrame:
    """Every record: kept columns, fields in their types, ``entered`` (the fields as text), ``accepted``, ``reasons``."""
    entered = F.struct(*[(F.col(f.name).cast("string") if f.name in df.columns else F.lit(None).cast("string")).alias(f.name)
                         for f in check.schema.fields])
    out = df.select(*keep, *[check.value(df, f).alias(f.name) for f in check.schema.fields if f.name not in keep],
                    entered.alias("entered"), check.reasons(df).alias("reasons"))
    return out.withColumn("accepted", F.size("reasons") == 0)


def split(df: DataFrame, check: Check, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): the fields in their types; the fields as entered, with ``reasons``."""
    rows = checked(df, check, keep)
    fields = [f.name for f in check.schema.fields if f.name not in keep]
    return (rows.where("accepted").select(*keep, *fields),
            rows.where("not accepted").select(*keep, *[f"entered.{c}" for c in fields], "reasons"))


def scored(df: DataFrame, check: Check, score: Callable[[DataFrame], DataFrame], outputs: Sequence[str],
           keep: Sequence[str] = ()) -> DataFrame:
    """Score all accepted records and carry the rejected ones along, in one projection.

    ``score`` adds the columns ``outputs`` to the typed fields.  A rejected record is scored on zeros, so that no
    stage of a pipeline meets a value it would fail on, and its outputs are NULL.  Returns the kept
    columns, the fields as text in ``entered``, the outputs, ``accepted`` and ``reasons``.
    """
    fields = [f.name for f in check.schema.fields if f.name not in keep]
    rows = checked(df, check, keep).withColumn("kept", F.struct("entered", "accepted", "reasons", *keep))
    typed = {f.name: f.dataType for f in check.schema.fields}
    rows = rows.select("kept", *[F.when(F.col("accepted"), F.col(c)).otherwise(
        F.lit(0).cast(typed[c]) if isinstance(typed[c], (*_WHOLE, *_FRACTION)) else F.lit(None).cast(typed[c])).alias(c)
        for c in [*fields, *[k for k in keep if k in typed]]])
    out = score(rows)
    ok = F.col("kept.accepted")
    return out.select(*[F.col(f"kept.{c}") for c in keep], F.col("kept.entered"),
                      *[F.when(ok, F.col(c)).alias(c) for c in outputs], ok.alias("accepted"), F.col("kept.reasons"))


def write_checked(df: DataFrame, path: str) -> None:
    """Accepted and rejected records of :func:`checked` or :func:`scored` in one write, a folder for each."""
    df.write.mode("overwrite").partitionBy("accepted").parquet(path)


def read_checked(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_checked`` or a stream partitioned by ``accepted`` wrote; a filter on it reads one folder."""
    return spark.read.parquet(path).withColumn("accepted", F.col("accepted").cast("boolean"))


def rejects(df: DataFrame) -> DataFrame:
    """(reason, n): how many records have each reason."""
    return (df.where("not accepted").select(F.explode("reasons").alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))
