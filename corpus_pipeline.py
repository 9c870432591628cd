"""The corpus pipeline: toxic texts go, then exact copies, then near copies; sources are mixed and the mix is encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marlspike.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from marlspike.llm.common import materialise

ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; it learns from the labelled documents of the stage's input."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that pairs at a five-word Jaccard similarity of 0.8 or more join."""
    return near_dedup.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken."""
    return mixing.mixed_rows(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row of the mix, with digests of the ids and of the text decoded from them."""
    return bpe.bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.json"), want=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
