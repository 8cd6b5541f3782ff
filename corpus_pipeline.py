"""The corpus pipeline: from raw documents to packed sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from obslayers.llm import near_duplicates, packing, quality_classifier
from obslayers.llm import quality_rules as rules
from obslayers.storage import Scratch, materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# What the last stage wrote for itself. A stage's result is written before the next one
# begins, so that one may delete it.
_finished: list[Scratch] = []


def _scratch(spark: SparkSession) -> Scratch:
    while _finished:
        _finished.pop().clear()
    _finished.append(Scratch(spark))
    return _finished[-1]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the risk-controlled rules reject go."""
    with _scratch(spark):
        return rules.keep_good(docs, _labels(spark, sf_dir))


def quality_classes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant predicts to be bad go."""
    with _scratch(spark):
        return quality_classifier.keep_good(docs, _labels(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    with _scratch(spark):
        return near_duplicates.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents left, packed into sequences of 1024 tokens."""
    with _scratch(spark):
        return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classes),
    ("near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]

# Neither the classifier nor the packing can be said in SQL; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
