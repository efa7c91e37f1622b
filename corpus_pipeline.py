"""A corpus pipeline of five stages over the documents of a table folder.

Each stage is a function of (spark, docs, sf_dir); what it returns is written and read again as the
next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm import bpe, decontaminate, quality_model, secrets, simhash
from usagelens.llm.common import table
from usagelens.llm.queries import vocabulary_path
from usagelens.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.classify(docs, model).where("score >= 0.5").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest id, of each group of near duplicates: fingerprints of
    three-word shingles that differ in two bits at most."""
    return simhash.keep_one(docs, size=3, bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold an item of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in place of every secret; ``n_chars`` follows the text."""
    clean = secrets.redact(docs, secrets.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of what they decode to."""
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary_path())
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secret_removal),
    ("bpe_encoding", encoding),
]

#: Fitted models decide which rows stay, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
