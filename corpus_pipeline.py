"""Training-corpus pipeline over ``documents``: five stages, each written and read again.

Every stage works on all rows its predecessor kept.  The first four return the columns of
``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskwise.llm import decontaminate, jaccard_join, language_id, packing, secret_scan
from riskwise.llm.queries import TOKENIZER
from riskwise.session import scratch_path, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents of undetermined language go (NULL text, no letters)."""
    names, prototypes = language_id.learn_profiles(docs.where(~language_id.held_out(docs["doc_id"])))
    return language_id.with_known_language(docs, names, prototypes)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group stays, that of smallest id."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents holding a passage of ``benchmark`` go."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every secret is replaced by its kind; all documents stay."""
    return secret_scan.redact_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: token ids of every document in sequences of at most 4096."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: Profiles, edit-distance search and tokenization have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; every stage's rows are written in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
