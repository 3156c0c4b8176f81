"""Registered queries of the document operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.llm import (conversations, exact_dedup, language_id, mixing, near_dup, pieces, pii, quality_rules, secrets, sharding,
                          token_align, token_counts, token_files)
from panelkit.llm.common import documents


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.suffix_sums(token_counts.histogram(token_counts.lengths(documents(spark, sf_dir))))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = near_dup.decide(documents(spark, sf_dir))
    return d.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_rows(documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = exact_dedup.decide(documents(spark, sf_dir))
    return d.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(documents(spark, sf_dir))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(documents(spark, sf_dir))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_docs(documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.predict(docs, language_id.fit(docs))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).drop("n_lines")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.round_trip(documents(spark, sf_dir))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.digest(conversations.damaged(documents(spark, sf_dir, "conversations")))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.digest(documents(spark, sf_dir))
