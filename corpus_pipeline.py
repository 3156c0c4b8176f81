"""The corpus pipeline: from raw documents to encoded ones.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. It works on all
that the stage before it kept, and what it decides takes effect: quality rules
drop documents, both de-duplications keep one document of a group, mixing drops
or repeats documents by source, and the last stage encodes what is left. All but
the last return the columns of documents, in their order.

The stages handle what their operators handle: null texts fail the quality
rules, null ids, languages and sources are carried, empty tables stay empty,
further columns pass through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import exact_dedup, mixing, near_dup, pieces, quality_rules
from panelkit.llm.common import documents
from panelkit.session import cut_lineage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_docs(docs)


STAGES = [
    ("quality rules", keep_good),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding", encode),
]

#: SQL cannot express the knapsack fit and the Viterbi search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents, each written before the next."""
    out = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, out if i == 0 else cut_lineage(out), sf_dir)
    return out
