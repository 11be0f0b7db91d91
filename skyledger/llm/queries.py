"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .batches import held_out_fold

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit, score_quality

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = held_out_fold(F.col("doc_id"), 5, 0)
    scored = score_quality(docs, fit(docs, labels.filter(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import packed

    return packed(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .credentials import find_secrets, fit

    docs = table(spark, sf_dir, "documents")
    return find_secrets(docs, fit(docs))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, score_toxicity

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = held_out_fold(F.col("doc_id"), 5, 0)
    scored = score_toxicity(docs, fit(docs, labels.filter(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import fit, predict_language

    docs = table(spark, sf_dir, "documents")
    held_out = held_out_fold(F.col("doc_id"), 3, 1)
    predicted = predict_language(docs, fit(docs.filter(~held_out)))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import token_ids

    return token_ids(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..session import scratch
    from .chat import canonical_turns, conversation_digests, formatted_turns, turn_records

    awkward = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", awkward), (-7, 1, "assistant", awkward)], "conv_id long, turn long, role string, text string")
    folder = scratch(spark, "chat")
    records = turn_records(table(spark, sf_dir, "conversations")).unionByName(turn_records(extra))
    formatted_turns(canonical_turns(records, turn="turn")).write.parquet(folder)
    return conversation_digests(spark.read.parquet(folder))


def op10_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .search import search

    return search(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import prefix_trie

    conv_id = F.col("conv_id")
    return prefix_trie(table(spark, sf_dir, "conversations"), conv_id - conv_id % 5, F.crc32(conv_id.cast("string")) % 9)


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .manifest import document_manifest

    return document_manifest(table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import TOKEN_LIMIT, count_tokens

    return count_tokens(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def all_queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def all_oracles() -> dict[str, str]:
    return {"op11_prefix_trie": oracles.PREFIX_TRIE, "op12_manifest": oracles.MANIFEST}
