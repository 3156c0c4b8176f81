"""Helpers shared by the document operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The white space that separates words: space, tab, newline, vertical tab,
#: form feed, carriage return.
SPACE = r"\x20\x09-\x0D"

#: A group that holds more than one row in this many is a hot group. At most
#: HOT_SHARE groups can be hot, whatever the table's size, so the list of hot
#: groups has a proven bound and may be broadcast.
HOT_SHARE = 1000


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def words(text: Column) -> Column:
    """Words of a text column (null: no words) as an array of strings."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Documents can be long: hand them to Python workers in batches of few
    rows, so that a worker's memory follows the text in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def hot_cold_join(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, n_rows: int) -> DataFrame:
    """Inner join of ``rows`` to ``groups`` (one row per key, ``size`` = the
    number of rows with that key) that no key can overload.

    Groups of more than n_rows / HOT_SHARE rows are at most HOT_SHARE many:
    they are broadcast and their rows stay where they are. The rest are
    joined by a shuffle in which no key has more rows than that share. Keys
    compare null-safe. ``rows`` is read twice, so pass a written table.
    """
    limit = max(1, n_rows // HOT_SHARE)
    hot = F.broadcast(groups.filter(F.col(size) > limit))
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    extra = [f"r.{c}" for c in groups.columns if c not in keys]
    a = rows.alias("l").join(hot.alias("r"), on, "inner").select("l.*", *extra)
    rest = rows.alias("l").join(hot.select(*keys).alias("r"), on, "left_anti")
    b = rest.alias("l").join(groups.filter(F.col(size) <= limit).alias("r"), on, "inner").select("l.*", *extra)
    return a.unionByName(b)
