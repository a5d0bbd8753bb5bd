"""One registered query for each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, counts, divergence, exact, fingerprints, jaccard, packing, passages, resampling, secrets, suffixes, tokens, toxicity
from tidemark.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    same = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", same), (-1, 1, "assistant", same)], "conv_id long, turn long, role string, text string")
    best = chat.best_branches(chat.turn_trees(turns.unionByName(added)))
    back = chat.read_back(chat.formatted(best))
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return back.select(
        F.col("tree_id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_neighbours(read_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return toxicity.scored(documents, toxicity.trained(documents, read_table(spark, sf_dir, "labels")))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.span_digests(secrets.secret_spans(read_table(spark, sf_dir, "documents")))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(read_table(spark, sf_dir, "documents")).drop("row")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_copies(read_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.without_earlier_passages(read_table(spark, sf_dir, "documents")).drop("kept")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(read_table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_chat_formatting, op2_suffix_dedup, op3_fingerprints, op4_toxicity, op5_secrets, op6_byte_bpe, op7_packing, op8_jaccard_join, op9_exact_dedup, op10_substring_dedup, op11_resampling, op12_divergence, op13_token_counts)}

ORACLES: dict[str, str] = {"op1_chat_formatting": chat.ORACLE, "op9_exact_dedup": exact.ORACLE, "op11_resampling": resampling.ORACLE, "op12_divergence": divergence.ORACLE}
