"""SNK-*: table sinks (model persistence lives in operators.modelling)."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Sequence

import pyarrow as pa

from pyspark.sql import DataFrame, functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite", sort_by: Sequence[str] = (), **opts) -> None:
    """SNK-1: overwrite a table; CSV gets a header row, no index. ``sort_by``
    orders the output (SRT-1, missing last) with a range-partitioned sort,
    so part files are in key order."""
    if sort_by:
        df = df.orderBy(*[F.col(c).asc_nulls_last() for c in sort_by])
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.options(**opts).save(path)


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """JSON objects, one per row, as the lines of one JSON array."""
    lead = "["
    for b in batches:
        lines = []
        for v in b["value"].to_pylist():
            lines.append(lead + v)
            lead = ","
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if lead == "[" else "]"])], names=["value"])


def write_records_json(df: DataFrame, path: str, as_single_array: bool = False) -> None:
    """SNK-2: JSON rows (one object per line), in parallel; or, for a small
    result, one array of row objects in a single file: the rows are made in
    parallel and one task writes them in their order, batch by batch."""
    if as_single_array:
        rows = df.select(F.to_json(F.struct("*")).alias("value")).withColumn("place", F.monotonically_increasing_id())
        (rows.repartition(1).sortWithinPartitions("place").select("value").mapInArrow(_as_array, "value string")
           .write.mode("overwrite").text(path))
    else:
        df.write.mode("overwrite").json(path)
