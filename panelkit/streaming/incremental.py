"""SRC-12: re-ingest newly landed release files and keep the newest row per key.

A Structured Streaming file source with ``trigger(availableNow=True)``
processes every file that landed since the last run (the checkpoint records
which), and ``foreachBatch`` merges each micro-batch into a
partitioned target: only partitions the batch touches are read and
rewritten (dynamic partition overwrite), with the newest row per key kept.
The merge is staged under the shared checkpoint folder first, because a
job may not overwrite the path it reads.

With ``versioned=True`` the target is published instead: a batch writes the
partitions it changes into a new version's folder and then, by one rename, the
list of (partition, version) pairs that make up the table. ``read_current`` reads
the newest list, so a reader sees the state before a batch or after it, never a
partition that is half rewritten; files of older versions stay as they are.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from panelkit.operators.series import join_on_keys, keep_last
from panelkit.session import checkpoint_dir, cut_lineage, drop_path


class MissingSourceError(RuntimeError):
    pass


def _target_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.globStatus(jvm.org.apache.hadoop.fs.Path(path + "/*"))) > 0


def merge_batch(batch: DataFrame, target: str, keys: Sequence[str], order: Sequence[str],
                partition_col: str) -> None:
    """Merge new rows into the target, keeping the newest row per key. Equal
    ``order`` values: the larger source file name, then the new row.

    Rewritten are the partitions of the new rows and those that hold an older
    row of the same keys, so a key that moves to another partition leaves
    nothing behind. The rows of the touched partitions are staged in the
    shared checkpoint folder first; a partition that ends empty is deleted.
    A rerun after a failure at any point gives the same target."""
    spark = batch.sparkSession
    rank = [*order, *[c for c in ("_source_file",) if c in batch.columns and c not in order], "_new"]
    fresh = batch.withColumn("_new", F.lit(1))
    stage = f"{checkpoint_dir(spark).rstrip('/')}/_stage_{uuid.uuid4().hex}"
    gone: list = []
    try:
        if _target_exists(spark, target):
            old = spark.read.parquet(target)
            touched = cut_lineage(batch.select(partition_col).union(
                old.join(batch.select(*keys).distinct(), list(keys), "left_semi").select(partition_col)).distinct())
            kept = old.join(touched, partition_col, "left_semi").withColumn("_new", F.lit(0))
            merged = keep_last(kept.unionByName(fresh, allowMissingColumns=True), keys, rank).drop("_new")
            merged.write.mode("overwrite").partitionBy(partition_col).parquet(stage)
            left = spark.read.schema(merged.schema).parquet(stage)
            gone = touched.join(left.select(partition_col).distinct(), partition_col, "left_anti").collect()  # partition names
        else:
            merged = keep_last(fresh, keys, rank).drop("_new")
            merged.write.mode("overwrite").partitionBy(partition_col).parquet(stage)
        (spark.read.schema(merged.schema).parquet(stage).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(partition_col).parquet(target))
        for row in gone:
            value = "__HIVE_DEFAULT_PARTITION__" if row[0] is None else row[0]
            drop_path(spark, f"{target.rstrip('/')}/{partition_col}={value}")
    finally:
        drop_path(spark, stage)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, target: str) -> list[int]:
    """Published versions, oldest first. Lists still being written have no
    number as their name."""
    fs, p = _fs(spark, f"{target.rstrip('/')}/_versions")
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n) for n in names if n.isdigit())


def read_current(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The table as of its newest (or a given) version. Partitions are chosen
    by a semi join on the partition columns, so only their files are read."""
    target = target.rstrip("/")
    published = versions(spark, target)
    if not published:
        raise MissingSourceError(f"nothing published in {target}")
    parts = spark.read.parquet(f"{target}/_versions/{version or published[-1]:08d}")
    return join_on_keys(spark.read.parquet(f"{target}/data"), F.broadcast(parts), parts.columns, "left_semi").drop("version")  # one row per partition


def publish_batch(batch: DataFrame, target: str, keys: Sequence[str], order: Sequence[str], partition_col: str) -> int:
    """Merge new rows into a versioned target (rules of :func:`merge_batch`) and
    return the version published. One writer at a time; a batch that runs again
    after a failure merges the same rows to the same result."""
    spark, target = batch.sparkSession, target.rstrip("/")
    published = versions(spark, target)
    last = published[-1] if published else 0
    rank = [*order, *[c for c in ("_source_file",) if c in batch.columns and c not in order], "_new"]
    rows = batch.withColumn("_new", F.lit(1))
    stay = None
    if last:
        old = read_current(spark, target)
        moved = join_on_keys(old, batch.select(*keys).distinct(), list(keys), "left_semi")
        touched = cut_lineage(batch.select(partition_col).union(moved.select(partition_col)).distinct())
        kept = join_on_keys(old, touched, [partition_col], "left_semi").withColumn("_new", F.lit(0))
        rows = kept.unionByName(rows, allowMissingColumns=True)
        stay = join_on_keys(spark.read.parquet(f"{target}/_versions/{last:08d}"), touched, [partition_col], "left_anti")
    version = last + 1
    merged = keep_last(rows, keys, rank).drop("_new")
    # rebalancing puts a partition's rows together, and splits one with very many
    merged.hint("rebalance", partition_col).write.mode("overwrite").partitionBy(partition_col).parquet(f"{target}/data/version={version}")
    written = spark.read.schema(merged.schema).parquet(f"{target}/data/version={version}")
    parts = written.select(partition_col).distinct().withColumn("version", F.lit(version))
    parts = parts.unionByName(stay) if stay is not None else parts
    draft = f"{target}/_versions/draft_{uuid.uuid4().hex}"
    parts.write.parquet(draft)
    fs, p = _fs(spark, draft)
    if not fs.rename(p, _fs(spark, f"{target}/_versions/{version:08d}")[1]):
        raise RuntimeError(f"version {version} of {target} could not be published")
    return version


def refresh(spark: SparkSession, landing: str, schema: StructType, target: str, keys: Sequence[str],
            order: Sequence[str], partition_col: str, fmt: str = "csv", checkpoint: str | None = None,
            prepare=None, required: bool = True, versioned: bool = False, **read_opts) -> int:
    """Run one incremental refresh; returns the number of micro-batches.

    ``prepare`` turns raw rows into (keys, order, partition_col, ...) rows
    (e.g. a cleaning plan). Raises :class:`MissingSourceError` when the
    landing folder holds no file at all and ``required`` is set."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(landing)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if required and (not fs.exists(p) or len(fs.listStatus(p)) == 0):
        raise MissingSourceError(f"no source files in {landing}")
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/refresh_{uuid.uuid5(uuid.NAMESPACE_URL, target).hex}"
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = reader.options(**read_opts).load(landing).withColumn("_source_file", F.col("_metadata.file_path"))
    if prepare is not None:
        stream = prepare(stream)
    batches = []

    def _each(batch: DataFrame, batch_id: int) -> None:
        (publish_batch if versioned else merge_batch)(batch, target, keys, order, partition_col)
        batches.append(batch_id)

    q = (stream.writeStream.foreachBatch(_each).option("checkpointLocation", ckpt)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)
