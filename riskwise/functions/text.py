"""Whole-text numeric features for the labelled learning set (built-in regex
functions only, evaluated in the JVM over the full text of every document)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_chars(text: Column, negated_class: str) -> Column:
    """Number of characters of ``text`` inside a character class."""
    return F.length(F.regexp_replace(text, f"[^{negated_class}]", ""))


def text_features(docs: DataFrame, text: str = "text") -> DataFrame:
    t = F.col(text)
    return docs.withColumns({
        "n_words": F.regexp_count(t, F.lit(r"\S+")).cast("long"),
        "n_lines": (F.regexp_count(t, F.lit("\n")) + 1).cast("long"),
        "n_digits": count_chars(t, "0-9").cast("long"),
        "n_punct": count_chars(t, ".,;:!?").cast("long"),
        "n_upper": count_chars(t, "A-Z").cast("long"),
    })


def labelled_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """documents joined with their labels (inner join on ``doc_id``), with text features.

    The planner chooses the join by the label table's size: broadcast labels are joined
    before the regexes run; beyond the broadcast threshold both sides are shuffled.
    """
    lab = labels.select("doc_id", "quality", "toxic")
    docs = documents.select("doc_id", "text", "n_chars")
    return text_features(docs.join(lab, "doc_id")).drop("text")
