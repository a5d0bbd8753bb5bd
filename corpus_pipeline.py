"""A training corpus from ``documents``: toxic texts out, copies out, near copies out, secrets masked, packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact, jaccard, packing, secrets, toxicity
from tidemark.llm.common import read_table, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.trained(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.without_similar(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

#: A trained classifier and a tokenizer's file are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows stored before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
