"""The registered queries of the operators, with production settings, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslayers.llm import (
    byte_bpe,
    chat_rotation,
    fingerprints,
    licenses,
    merkle,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    spelling,
    token_counts,
    url_filters,
    wrappers,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_rotation.rotate(_table(spark, sf_dir, "conversations"))
    # SQL results hold no lists of structs: the spans as text.
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["begin"], s["end"]))
    return rows.withColumn("spans", F.array_join(spans, " "))


def op2_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048
    )


def op5_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_text(_table(spark, sf_dir, "pages"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encoding_digests(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    judged = url_filters.judge_captures(url_filters.page_captures(pages), url_filters.page_entries(pages))
    return judged.withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"), threshold=0.8)
    return found.select("doc_id", "class_id", "n_links")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_chat_rotation": op1_chat_rotation,
    "op2_pack_documents": op2_pack_documents,
    "op3_quality_rules": op3_quality_rules,
    "op4_count_tokens": op4_count_tokens,
    "op5_wrapper_text": op5_wrapper_text,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_url_filters": op7_url_filters,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_fingerprints": op10_fingerprints,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_license_scans": op13_license_scans,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_rotation": chat_rotation.ORACLE_SQL,
    "op3_quality_rules": quality_rules.ORACLE_SQL,
    "op7_url_filters": url_filters.ORACLE_SQL,
    "op11_merkle_manifest": merkle.ORACLE_SQL,
    "op12_spelling_variants": spelling.ORACLE_SQL,
}
