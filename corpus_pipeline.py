"""Cleaning and mixing a corpus: STAGES in order, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlight.llm import decontamination, jaccard, mixing, secret_scan, toxicity
from harborlight.llm._sample import fold
from harborlight.session import stored

#: The mix and the trained models can't be told in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled ones of the corpus, does not reject."""
    labels = _read(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 4) != 2).select("doc_id", F.col("toxic").alias("label"))
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word-shingle Jaccard 0.8 or more."""
    return jaccard.keep_one(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontamination.decontaminate(docs, _read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    return secret_scan.redact(docs, secret_scan.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: each document as often as its source's rate says, numbered by `copy`."""
    return mixing.emit_mix(mixing.plan_mix(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's result is written and read again."""
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
