"""Token ids as Parquet files for selective reads.

Documents are range-partitioned and sorted by id, encoded, and written as one
file per partition: an id list column and, beside it, the metadata (doc_id,
n_tokens, shard, shard_start). Format version 2 pages hold dictionary codes, or
delta-packed integers where a dictionary does not pay; row groups and pages have
fixed sizes; column and offset indexes let a reader fetch the ids of a few
documents, or the metadata alone, without reading the rest.

Encoding runs after the range partitioning, so texts shuffle once (ids would be
larger) and the sampling of the ranges never encodes. A tokenizer that splits
texts into lower-cased words (checked when it is loaded) never crosses white
space or the end of a word: its distinct chunks are encoded once and kept by the
worker, words by its merge model directly, all else by the whole tokenizer. Any
other tokenizer encodes whole texts.

Defined results: a null text has the end id only; null ids come first; equal ids
are ordered by their text's hash and text; an empty table writes no ids and
reads back empty; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from panelkit.llm.chunks import ChunkIds, batches_of_chars, joined
from panelkit.llm.common import small_batches
from panelkit.session import table_path

END_ID = 1
FORMAT = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "true",
          "parquet.block.size": str(32 << 20), "parquet.page.size": str(256 << 10),
          "parquet.page.row.count.limit": "2000", "parquet.page.write.checksum.enabled": "true", "compression": "zstd"}
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
WORD = re.compile(f"[{LETTERS}]+")
#: A mark that alone ends a word is a piece of its own.
LAST_MARK = f"([{LETTERS}])([.,;:!?|])( |$)"
#: The settings of a tokenizer whose pieces are lower-cased words,
#: single digits and runs of other characters.
WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def splits_words(spec: dict) -> bool:
    """Whether a tokenizer file describes such a tokenizer."""
    split = [p for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
    return ((spec["normalizer"] or {}).get("normalizers") == WORD_NORMALIZERS and [p["type"] for p in split] == ["Split", "ByteLevel"]
            and split[0]["pattern"] == {"Regex": WORD_SPLIT} and not split[1]["add_prefix_space"] and not split[1]["use_regex"])


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path) as f:
            self.by_word = splits_words(json.load(f))
        self.letters = byte_letters()
        self.kept = ChunkIds(self.chunk_ids, limit=400_000)

    def chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out: list = [None] * len(chunks)
        other = []
        for i, c in enumerate(chunks):
            if c.isascii() and c.isalpha():
                out[i] = [t.id for t in self.tok.model.tokenize(c.lower())]
            elif WORD.fullmatch(c):
                out[i] = [t.id for t in self.tok.model.tokenize(c.lower().encode().decode("latin-1").translate(self.letters))]
            else:
                other.append(i)
        for i, e in zip(other, self.tok.encode_batch_fast([chunks[i] for i in other], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return joined(out)

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and each text's number."""
        if self.by_word:
            return self.kept.ids_of(*split(texts))
        return joined([e.ids for e in self.tok.encode_batch_fast(pc.fill_null(texts, "").to_pylist(), add_special_tokens=False)])


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    import public_tokenizers

    return Encoder(public_tokenizers.path(vocabulary))


def split(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Parts of the texts between spaces, tabs and line ends (empty ones
    included) and last marks: the distinct parts, every part's position among
    them, and each text's number of parts. Letters A to Z are lower-cased
    before, but not where special tokens may stand."""
    t = pc.fill_null(texts, "")
    t = pc.if_else(pc.match_substring(t, "<|"), t, pc.ascii_lower(t))
    for c in "\n\t\r":
        t = pc.replace_substring(t, c, " ")
    t = pc.replace_substring_regex(t, LAST_MARK, r"\1 \2\3")
    parts = pc.split_pattern(t, " ")
    coded = parts.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), pc.list_value_length(parts).to_numpy()


def encode_docs(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                shards: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, shard, shard_start, ids) in ascending order: shards
    and rows inside them are both ordered by id."""
    spark = docs.sparkSession
    small_batches(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    d = d.withColumn("h", F.xxhash64("text"))
    d = d.repartitionByRange(shards, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, start = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for b in batches:
            texts = b["text"]
            for first, end in batches_of_chars(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                flat, n = enc.ids_of(texts[first:end])
                ends = np.cumsum(n)
                flat, n = np.insert(flat, ends, END_ID), n + 1
                offsets = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"][first:end], pa.array(n), pa.array(np.full(len(n), shard, np.int32)), pa.array(start + offsets[:-1]),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))],
                    names=["doc_id", "n_tokens", "shard", "shard_start", "ids"])
                start += int(offsets[-1])

    return d.mapInArrow(run, "doc_id long, n_tokens long, shard int, shard_start long, ids array<int>")


def write(encoded: DataFrame, path: str) -> None:
    encoded.write.options(**FORMAT).mode("overwrite").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Metadata alone, with each document's ``start`` in the whole id stream.
    The offsets of the shards are one row per file."""
    m = spark.read.parquet(path).select("doc_id", "n_tokens", "shard", "shard_start")
    return m.join(F.broadcast(shard_offsets(m)), "shard").select("doc_id", (F.col("offset") + F.col("shard_start")).alias("start"), "n_tokens")


def shard_offsets(meta: DataFrame) -> DataFrame:
    sums = meta.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """crc32 of every id list as little-endian unsigned 32-bit integers."""
    for b in batches:
        ids = b["ids"]
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        crc = [zlib.crc32(x.tobytes()) for x in np.split(flat, ends[:-1])] if len(ends) else []
        yield pa.RecordBatch.from_arrays([*[b[c] for c in ("doc_id", "n_tokens", "shard", "shard_start")], pa.array(crc, pa.int64())],
                                         names=["doc_id", "n_tokens", "shard", "shard_start", "ids_crc32"])


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: start, n_tokens, ids_crc32."""
    small_batches(spark)
    t = spark.read.parquet(path)
    s = t.mapInArrow(checksums, "doc_id long, n_tokens long, shard int, shard_start long, ids_crc32 long")
    return s.join(F.broadcast(shard_offsets(t)), "shard").select(
        "doc_id", (F.col("offset") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", path: str | None = None) -> DataFrame:
    """Encode, write to ``path`` (by default a new folder in the shared
    checkpoint folder), read back and digest."""
    spark = docs.sparkSession
    path = path or table_path(spark, "token_files")
    write(encode_docs(docs, vocabulary), path)
    return digest(spark, path)
