"""Exact token counts: a length histogram with suffix sums.

Documents are encoded once and aggregated by (source, encoded length). From the
histogram alone, suffix sums answer for every context limit L: how many
documents and tokens are longer, what the total is when texts are cut at L, and
which length any quantile has. The histogram has one row per source and
distinct length, so everything after the first aggregation is small.

Suffix sums run in two levels (inside blocks of lengths, then over the blocks),
so that no task holds all lengths of a source.

Defined results: a null text has no tokens (length 0); a null source is a source
of its own; ids and further columns are ignored; repeated rows count repeatedly;
an empty table gives an empty histogram.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelkit.llm.common import small_batches
from panelkit.session import cut_lineage

BLOCK = 1024  # lengths in a block


@lru_cache(maxsize=2)
def _encoder(vocabulary: str):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded_length(text: str | None, vocabulary: str) -> int:
    return len(_encoder(vocabulary).encode_ordinary(text)) if text else 0


def lengths(docs: DataFrame, text_col: str = "text", source_col: str = "source",
            vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(source, n_tokens) of every document."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [encoded_length(x.as_py(), vocabulary) for x in b["text"]]
            yield pa.RecordBatch.from_arrays([b["source"], pa.array(n, pa.int64())], names=["source", "n_tokens"])

    d = docs.select(F.col(f"`{source_col}`").cast("string").alias("source"), F.col(f"`{text_col}`").alias("text"))
    return d.mapInArrow(count, "source string, n_tokens bigint")


def histogram(lengths_: DataFrame) -> DataFrame:
    """(source, n_tokens, n_docs), written once: it is read several times."""
    return cut_lineage(lengths_.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n_docs")))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For each row as a context limit L = n_tokens of its source:
    docs_over / tokens_over: documents longer than L and their tokens;
    truncated_total: tokens left when every text is cut at L;
    docs_upto, share_upto: documents of at most L tokens, as count and share
    (the smallest L with share_upto >= q is the q-quantile);
    total_docs, total_tokens: of the source."""
    tokens = F.col("n_tokens") * F.col("n_docs")
    h = hist.withColumn("block", F.floor(F.col("n_tokens") / BLOCK).cast("long"))
    blocks = h.groupBy("source", "block").agg(F.sum("n_docs").alias("bd"), F.sum(tokens).alias("bt"))
    later = Window.partitionBy("source").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("source")
    blocks = blocks.select("source", "block",
                           F.coalesce(F.sum("bd").over(later), F.lit(0)).alias("ld"),
                           F.coalesce(F.sum("bt").over(later), F.lit(0)).alias("lt"),
                           F.sum("bd").over(every).alias("total_docs"), F.sum("bt").over(every).alias("total_tokens"))
    inside = Window.partitionBy("source", "block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    h = h.select("*", F.coalesce(F.sum("n_docs").over(inside), F.lit(0)).alias("id_"),
                 F.coalesce(F.sum(tokens).over(inside), F.lit(0)).alias("it_"))
    j = h.alias("h").join(blocks.alias("b"), (F.col("h.block") == F.col("b.block")) & F.col("h.source").eqNullSafe(F.col("b.source")))
    over_d, over_t = F.col("id_") + F.col("ld"), F.col("it_") + F.col("lt")
    return j.select("h.source", "n_tokens", "n_docs", "total_docs", "total_tokens",
                    over_d.alias("docs_over"), over_t.alias("tokens_over"),
                    (F.col("total_tokens") - over_t + F.col("n_tokens") * over_d).alias("truncated_total"),
                    (F.col("total_docs") - over_d).alias("docs_upto"),
                    ((F.col("total_docs") - over_d) / F.col("total_docs")).alias("share_upto"))


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(source, context_limit, truncated_total, docs_over) for given limits,
    straight from the histogram."""
    lim = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("context_limit")
    over = F.col("n_tokens") > F.col("context_limit")
    return (hist.select("*", lim).groupBy("source", "context_limit")
            .agg(F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("truncated_total"),
                 F.sum(F.when(over, F.col("n_docs")).otherwise(0)).alias("docs_over")))
