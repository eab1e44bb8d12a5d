"""Cleaning of a training corpus: STAGES in their order, and run() over the documents of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkgraph.llm import decontaminate, minhash, pii, sentencepiece, toxicity
from linkgraph.llm.common import remove, scratch, table
from linkgraph.llm.queries import piece_model


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects; it learns from this stage's own documents."""
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that links of 0.8 on five-word shingles join."""
    return minhash.keep_one(docs)


def stage_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by marks; n_chars is then that of the new text."""
    return pii.redact(docs, pii.train(docs)).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def stage_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document with the end id, and the text that they decode to, beside lang and source."""
    return sentencepiece.encode(docs, piece_model(), keep=["lang", "source"])


STAGES = [
    ("toxicity", stage_toxicity),
    ("minhash", stage_near_duplicates),
    ("benchmark", stage_benchmark),
    ("pii", stage_pii),
    ("sentencepiece", stage_tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written as Parquet in the shared folder and read again, and those of the stage before removed."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
