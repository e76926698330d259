"""Scalar column functions (all JVM-side, codegen-friendly expressions)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwise import roles


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def zeros_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Replace 0, and NaN, by NULL in the given columns (one projection)."""
    floating = {n for n, t in df.dtypes if t in ("double", "float")}
    return df.withColumns({c: F.expr(f"nullif({f'nanvl(`{c}`, null)' if c in floating else f'`{c}`'}, 0)")
                           for c in cols})


def to_double(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Cast features to double, so imputing a fractional surrogate is not truncated."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def clip(col, lo: float, hi: float) -> Column:
    """Clamp into [lo, hi]; NULL and NaN become NULL (``least``/``greatest`` alone skip NULLs)."""
    c = _c(col)
    return F.when(c.isNotNull() & ~F.isnan(c.cast("double")), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def clip_columns(df: DataFrame, bounds: dict) -> DataFrame:
    return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in bounds.items()})


def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def margin_to_probability(raw_col, index: int = 1) -> Column:
    """Pseudo-probability of a margin model from its rawPrediction vector.

    ``1 / (1 + exp(raw[0]))`` equals ``sigmoid(raw[1])`` because raw[0] = -raw[1].
    """
    from pyspark.ml.functions import vector_to_array

    return sigmoid(vector_to_array(_c(raw_col))[index])


def vector_element(vec_col, index: int) -> Column:
    """P10: element of an ML vector without a Python worker."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(_c(vec_col))[index]


def risk_probability(df: DataFrame, prob_col: str = "probability",
                     raw_col: str = "rawPrediction", pred_col: str = "prediction") -> Column:
    """Schema-aware risk: probability[1] if present, else the margin link, else the label."""
    if prob_col in df.columns:
        return vector_element(prob_col, 1)
    if raw_col in df.columns:
        return margin_to_probability(raw_col)
    return _c(pred_col).cast("double")


def scored_risk(df: DataFrame, prob_col: str = "probability", pred_col: str = "prediction") -> Column:
    """P8 in scoring: probability[1] if the model has one, else the predicted label as 0.0 or 1.0.

    (``risk_probability``, with the margin link between the two, is the form of the predictions export.)
    """
    return vector_element(prob_col, 1) if prob_col in df.columns else _c(pred_col).cast("double")


def risk_pct(p, digits: int = 1) -> Column:
    """Percentage rounded to ``digits`` places."""
    return F.round(_c(p) * 100.0, digits)


def pct_text(p, digits: int = 2) -> Column:
    """Percentage text such as ``'37.50%'``."""
    return F.format_string(f"%.{digits}f%%", _c(p) * 100.0)


def outcome_word(pred, words: Sequence[str] = roles.OUTCOME_WORDS) -> Column:
    """0/1 prediction to a word; NULL stays NULL."""
    c = _c(pred)
    return F.when(c == 1, F.lit(words[1])).when(c == 0, F.lit(words[0]))


def risk_band(pct, edges: Sequence[float] = roles.BAND_EDGES,
              names: Sequence[str] = roles.BAND_NAMES) -> Column:
    """Band of a risk percentage: below edge 0, below edge 1, ..., else last."""
    c = _c(pct)
    expr = F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(None).cast("string"))
    for edge, name in zip(edges, names):
        expr = expr.when(c < edge, F.lit(name))
    return expr.otherwise(F.lit(names[len(edges)]))


def _rule_messages(rules: Sequence[tuple]) -> list:
    """One CASE per rule: its text when the value is above the threshold, else NULL.

    ``rules`` holds (column, threshold, text); ``{value:.1f}`` in a text is filled
    with the record's value.
    """
    parts = []
    for col, thr, text in rules:
        if "{value:.1f}" in text:
            head, tail = text.split("{value:.1f}", 1)
            msg = F.concat(F.lit(head), F.format_string("%.1f", F.col(col)), F.lit(tail))
        else:
            msg = F.lit(text)
        parts.append(F.when(F.col(col) > thr, msg))
    return parts


def guidance_lines(rules: Sequence[tuple], default: str) -> Column:
    """Ordered list of triggered guidance lines, or the default line."""
    arr = F.filter(F.array(*_rule_messages(rules)), lambda x: x.isNotNull())
    return F.when(F.size(arr) == 0, F.array(F.lit(default))).otherwise(arr)


def guidance_text(rules: Sequence[tuple], default: str, sep: str = "\n") -> Column:
    """P14 + R6: triggered lines joined by ``sep`` (default line when none fires).

    Written with ``concat_ws`` over CASEs so the same text is expressible in SQL.
    """
    joined = F.concat_ws(sep, *_rule_messages(rules))
    return F.when(joined == "", F.lit(default)).otherwise(joined)


RULES = 10_000            # rows of a rule table
RULE_SCHEMA = "position int, column string, above double, upto double, text string"


def rule_lines(df: DataFrame, rules: DataFrame, default: str, sep: str = "\n") -> Column:
    """P14 + R6 with the rules as data: the texts of all rules that a record meets, by position, or the default.

    A rule (``RULE_SCHEMA``) is met by a value above ``above`` and not above ``upto``; a NULL bound is none, a NULL or NaN value
    meets no rule.  ``{value:.1f}`` in a text is filled with the value.  Rules may overlap; equal positions go by
    column, bounds and text.  The rules become one array of at most ``RULES`` entries that every record is
    held against in place, so nothing is joined or shuffled; an unknown column is an error.
    """
    found = [tuple(r) for r in rules.select("position", "column", "above", "upto", "text").limit(RULES + 1).collect()]
    if len(found) > RULES:
        raise ValueError(f"more than {RULES} rules")
    unknown = sorted({c for _, c, *_ in found} - set(df.columns))
    if unknown:
        raise ValueError(f"rules on columns that the records lack: {unknown}")
    if not found:
        return F.lit(default)
    names = sorted({c for _, c, *_ in found})
    order = sorted(found, key=lambda r: tuple((x is not None, x) for x in r))
    table = F.array(*[F.struct(F.lit(names.index(c)).alias("at"), F.lit(lo).cast("double").alias("above"),
                               F.lit(hi).cast("double").alias("upto"), F.lit(text).alias("text")) for _, c, lo, hi, text in order])
    values = F.array(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in names])

    def met(r: Column) -> Column:
        v = values[r["at"]]
        return v.isNotNull() & F.coalesce(v > r["above"], F.lit(True)) & F.coalesce(v <= r["upto"], F.lit(True))

    def said(r: Column) -> Column:
        return F.replace(r["text"], F.lit("{value:.1f}"), F.format_string("%.1f", values[r["at"]]))

    lines = F.transform(F.filter(table, met), said)
    return F.when(F.size(lines) == 0, F.lit(default)).otherwise(F.array_join(lines, sep))


def metric_label(name) -> Column:
    """``roc_auc`` -> ``ROC-AUC``."""
    return F.replace(F.upper(_c(name)), F.lit("_"), F.lit("-"))


def fixed4(x) -> Column:
    """Fixed 4-decimal text."""
    return F.format_string("%.4f", _c(x))


def clock(ts) -> Column:
    """``HH:mm:ss`` of an event time."""
    return F.date_format(_c(ts), "HH:mm:ss")


def record_tag(key, prefix: str = "PT") -> Column:
    """Stable record tag such as ``PT-0042`` from a real key."""
    return F.format_string(f"{prefix}-%04d", _c(key))


def linear_margin(cols: Sequence, weights: Sequence[float], intercept: float) -> Column:
    """P20: ``intercept + sum(w_i * x_i)``."""
    expr = F.lit(float(intercept))
    for c, w in zip(cols, weights):
        expr = expr + F.lit(float(w)) * _c(c)
    return expr


def report_text(measurements: Sequence[tuple], rules: Sequence[tuple], default: str, prediction, p,
                imputed: Sequence[str] = (), words: Sequence[str] = roles.DIAGNOSIS_WORDS) -> Column:
    """Multi-line report from the values as entered, the outcome and the guidance.

    ``measurements`` holds (column, name, format, unit); a NULL value is "not measured".  Columns in
    ``imputed`` that are 0 or missing get a note that scoring filled them.
    """
    lines = [F.lit("MEASUREMENTS:")]
    for col, name, fmt, unit in measurements:
        value = F.format_string(f"- {name}: {fmt}{' ' + unit if unit else ''}", F.col(col))
        lines.append(F.when(F.col(col).isNull(), F.lit(f"- {name}: not measured")).otherwise(value))
    lines += [F.lit("OUTCOME:"),
              F.concat(F.lit("- Predictive Diagnostic: "), outcome_word(prediction, words)),
              F.concat(F.lit("- Confidence Score: "), pct_text(p, 2))]
    for col in imputed:
        x = F.col(col).cast("double")
        lines.append(F.when(x.isNull() | F.isnan(x) | (x == 0), F.lit(f"- Imputed for scoring: {col}")))
    return F.concat_ws("\n", *lines, F.lit("GUIDANCE:"), guidance_text(rules, default))
