"""A training corpus from raw documents, stage by stage.

Each stage reads all rows that the one before has kept. ``run`` writes what a
stage returns to the shared folder and hands the next one what it reads there,
so a lost executor costs the stage it worked on at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import credentials, decontamination, quality, simhash
from skyledger.llm.batches import held_out_fold
from skyledger.llm.packing import packed
from skyledger.session import scratch

ACCEPTED = 0.3
SHINGLE, RADIUS = 3, 3
# After four other stages executors have less memory left than for packing alone.
CACHED = 150_000


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the additive model accepts; labels of one fold are never learnt from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out_fold(F.col("doc_id"), 5, 0))
    return quality.accepted(docs, quality.fit(docs, labels), ACCEPTED)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that fingerprints link."""
    return simhash.deduplicated(docs, SHINGLE, RADIUS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold an item of the benchmark."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents, with their secrets replaced by the kind of each."""
    clean = credentials.redact_secrets(docs, credentials.fit(docs))
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return clean


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into training sequences: one row per piece of a document."""
    return packed(docs, cached=CACHED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# Trained models, XXH64 fingerprints and token ids have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
