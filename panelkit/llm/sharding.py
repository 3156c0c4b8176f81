"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records uniformly into buckets by a seeded hash; the number
of buckets follows the bytes of the table, so a bucket fits in a worker's memory.
Pass 2 sorts each bucket by hash, shuffles it with a seeded Fisher-Yates shuffle and
writes it. The buckets one after the other are a random order of the whole
table, and the shards are consecutive stretches of that order: their row counts
differ by one at most (law ``rows``).

A record moves once. The positions come from the row counts of the buckets,
one number each: running sums in two levels, joined on the bucket.

The hash covers the id and the text, not the place of a row in the input, so the
order depends on the rows and the number of buckets alone. Repeated rows (same id and text)
have one hash: those that together fill more than a bucket are scattered by
their row number too. There are at most as many such groups as buckets, so
their list is broadcast. ``docs`` has to be a table, whose rows come in the same
order whenever they are read; write a derived frame first.

A lost executor costs its tasks: the scatter is a deterministic function of the
rows, each bucket is sorted before it is shuffled, and the seed of its shuffle
is the bucket's number, so a task that runs again writes the same rows.

Defined results: a null text has 8 bytes; null ids hash like a fixed id; repeated
rows stay; an empty table writes nothing and reads back empty; columns of any
name are carried in the struct ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from panelkit.llm.common import small_batches, text_or_empty
from panelkit.llm.near_dup import grouped
from panelkit.session import cut_lineage, table_path

SHARDS = 24
BUCKET_BYTES = 32 << 20
ROW_BYTES = 8  # counted for each record beside its text
BLOCK = 1024  # buckets whose rows are added up in one task


def record_size(text: Column) -> Column:
    return (F.octet_length(text_or_empty(text)) + ROW_BYTES).cast("long")


def record_hash(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, text)


def hot_repeats(docs: DataFrame, id_col: str, text_col: str, seed: int, bucket_bytes: int) -> DataFrame:
    """(h) of rows that repeat and fill more than a bucket: at most one per bucket."""
    t = F.col(f"`{text_col}`")
    h = docs.select(record_hash(F.col(f"`{id_col}`"), t, seed).alias("h"), record_size(t).alias("size"))
    h = h.groupBy("h").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    return h.filter((F.col("n") > 1) & (F.col("bytes") > bucket_bytes)).select("h")


def scatter(docs: DataFrame, buckets: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 0,
            bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(bucket, h, row): every record with the bucket that its hash draws."""
    rows = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("rid"),
                       record_hash(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), seed).alias("h"))
    hot = cut_lineage(hot_repeats(docs, id_col, text_col, seed, bucket_bytes)).withColumn("hot", F.lit(True))
    rows = rows.join(F.broadcast(hot), "h", "left")
    h = F.when(F.col("hot"), F.xxhash64("h", "rid")).otherwise(F.col("h"))
    bucket = F.pmod(F.xxhash64(h, F.lit(seed)), F.lit(buckets).cast("long"))  # independent of the order by h
    return rows.select(bucket.alias("bucket"), h.alias("h"), "row")


def bucket_starts(rows: DataFrame) -> DataFrame:
    """(bucket, start): the number of records in earlier buckets. Buckets are
    added up in blocks, then the blocks."""
    n = cut_lineage(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
    n = n.withColumn("block", F.floor(F.col("bucket") / BLOCK))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per BLOCK buckets
    blocks = n.groupBy("block").agg(F.sum("n").alias("n")).select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    n = n.select("block", "bucket", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("own"))
    return n.join(blocks, "block").select("bucket", (F.col("base") + F.col("own")).alias("start"))


def place(at: np.ndarray, total: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of positions in the whole order: the first total % shards
    shards have one record more than the others."""
    size, longer = divmod(total, shards)
    edge = longer * (size + 1)
    first, rest = np.divmod(at, size + 1), np.divmod(at - edge, max(size, 1))
    early = at < edge
    return np.where(early, first[0], longer + rest[0]), np.where(early, first[1], rest[1])


def shuffled(rows: DataFrame, starts: DataFrame, total: int, shards: int, seed: int) -> DataFrame:
    """(shard, slot, row): each bucket shuffled and laid at its place."""
    spark = rows.sparkSession
    small_batches(spark)
    schema = StructType([StructField("shard", IntegerType()), StructField("slot", LongType()), rows.schema["row"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, "bucket"):
            bucket = t["bucket"].to_numpy()
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for first, end in zip([0, *cuts], [*cuts, len(bucket)]):
                own = t.slice(first, end - first)
                # numpy's permutation is a Fisher-Yates shuffle
                order = np.random.default_rng([seed, int(bucket[first])]).permutation(len(own))
                at = np.arange(len(own)) + own["start"][0].as_py()
                shard, slot = place(at, total, shards)
                out = pa.table([pa.array(shard, pa.int32()), pa.array(slot, pa.int64()), own["row"].take(pa.array(order))],
                               names=["shard", "slot", "row"])
                yield from out.to_batches(max_chunksize=512)

    return (rows.join(starts, "bucket").repartition("bucket").sortWithinPartitions("bucket", "h")
            .select("bucket", "start", "row").mapInArrow(run, schema))


def write(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", seed: int = 0,
          bucket_bytes: int = BUCKET_BYTES) -> None:
    """Shuffle ``docs`` into ``shards`` folders of Parquet files under ``path``."""
    spark = docs.sparkSession
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(record_size(F.col(f"`{text_col}`"))), F.lit(0))).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // bucket_bytes))
    rows = scatter(docs, buckets, id_col, text_col, seed, bucket_bytes)
    starts = cut_lineage(bucket_starts(rows))
    shuffled(rows, starts, n, shards, seed).write.partitionBy("shard").mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """The written records: shard, slot, row."""
    schema = StructType([StructField("slot", LongType()), StructField("row", docs.schema), StructField("shard", IntegerType())])
    return spark.read.schema(schema).parquet(path)


def digest(written: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per record, from the files: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    t = F.col(f"row.`{text_col}`")
    return written.select(F.col(f"row.`{id_col}`").alias("doc_id"), record_size(t).alias("size"),
                          F.crc32(text_or_empty(t).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
                          F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def round_trip(docs: DataFrame, shards: int = SHARDS, seed: int = 0, path: str | None = None) -> DataFrame:
    """Shuffle, write to ``path`` (by default a new folder in the shared
    checkpoint folder), read back and digest."""
    spark = docs.sparkSession
    path = path or table_path(spark, "panelkit_shards")
    write(docs, path, shards, seed=seed)
    return digest(read(spark, path, docs))
