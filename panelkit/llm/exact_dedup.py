"""Exact de-duplication with a two-pass Bloom filter, in DataFrame functions.

Pass 1 hashes every text digest to Bloom positions and counts how often each is
hit. Positions hit twice or more form the "possibly repeated" filter, stored as
bitmaps. Pass 2 probes each digest: one with a position outside the filter occurs
once and passes straight through; only the rest shuffle to be grouped by digest.
False positives cost a little shuffle and never change the result.

Only (row id, doc_id, digest) rows move, never texts. The filter's size follows
the row count up to ``max_filter_bits``, which is what bounds the broadcast;
past it the filter lets more singles through to the grouping.

Defined results: a null text counts as empty; null ids are smaller than any id;
of fully equal ids in one group a single row stays (the earliest read); an
empty table gives an empty result; further columns of any name are carried by
``keep_one`` and ignored by ``decide``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.llm import bloom
from panelkit.llm.common import hot_cold_join, text_or_empty
from panelkit.session import cut_lineage


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text_or_empty(text).cast("binary"), 256)).alias("sha")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           max_filter_bits: int = 1 << 31) -> DataFrame:
    """One row per document: rid, doc_id, sha, keep_id, group_size, kept."""
    rows = cut_lineage(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                                   digest(F.col(f"`{text_col}`"))))
    n = rows.count()
    bits = bloom.filter_bits(n, max_filter_bits)
    repeated = bloom.build(rows, F.col("sha"), bits, hits=2)
    probed = cut_lineage(bloom.probe(rows, F.col("sha"), repeated, bits))
    single = probed.filter(~F.col("maybe")).select(
        "rid", "doc_id", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"))
    maybe = probed.filter("maybe").drop("maybe")
    groups = (maybe.groupBy("sha")
              .agg(F.max(F.struct("doc_id", (-F.col("rid")).alias("nrid"))).alias("top"), F.count(F.lit(1)).alias("group_size"))
              .select("sha", F.col("top.doc_id").alias("keep_id"), (-F.col("top.nrid")).alias("keep_rid"), "group_size"))
    grouped = hot_cold_join(maybe, cut_lineage(groups), ["sha"], "group_size", n).select(
        "rid", "doc_id", "sha", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"))
    return single.unionByName(grouped)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             max_filter_bits: int = 1 << 31) -> DataFrame:
    """docs without its surplus copies, all columns kept. Rows that the filter
    lets through never shuffle. The rest are grouped by digest, and each map
    task sends at most one row of a group, however large the group is."""
    rows = docs.select(F.struct("*").alias("row"))
    sha = digest(F.col(f"row.`{text_col}`"))
    bits = bloom.filter_bits(docs.count(), max_filter_bits)
    repeated = cut_lineage(bloom.build(rows.select(sha), F.col("sha"), bits, hits=2))
    rows = rows.select("row", F.col(f"row.`{id_col}`").cast("long").alias("doc_id"), sha)
    probed = bloom.probe(rows, F.col("sha"), repeated, bits)
    tie = F.xxhash64(F.to_json("row"))  # rows of one id and text may differ elsewhere
    top = (probed.filter("maybe").groupBy("sha")
           .agg(F.max_by("row", F.struct("doc_id", tie)).alias("row")).select("row.*"))
    return probed.filter(~F.col("maybe")).select("row.*").unionByName(top)
