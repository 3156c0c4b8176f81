"""Mergeable sketches: small tables per key and period that add up.

AGG-6 beyond memory: values are counted in logarithmic bins (neighbours differ by a
factor), so a quantile is off by half the factor's excess at most, and sketches
of periods or partitions merge by adding counts. AGG-17: distinct counts
from HyperLogLog sketches, which merge without the values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

GAMMA = 1.02  # bins of 2 %: estimates within 1 % of the value


def quantile_sketch(df: DataFrame, value: str, keys: Sequence[str] = (), gamma: float = GAMMA) -> DataFrame:
    """keys, sign, bin, n: values counted by sign and bin (0 has no bin).
    Missing values and NaN are left out; counts combine inside map tasks."""
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(
        *keys, F.signum(v).cast("int").alias("sign"), F.when(v != 0, F.ceil(F.log(F.abs(v)) / F.log(F.lit(gamma)))).cast("long").alias("bin"))
    return rows.groupBy(*keys, "sign", "bin").agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(sketch: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The sketch of fewer keys, such as all periods together."""
    return sketch.groupBy(*keys, "sign", "bin").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketch: DataFrame, qs: Sequence[float], keys: Sequence[str] = (), gamma: float = GAMMA) -> DataFrame:
    """keys, q, estimate, n: the middle of the bin that holds the value at rank
    ceil(q n). A key has as many rows as bins between its extremes (about 1200
    per factor of 2^34), so its window is small whatever the data."""
    mid = F.pow(F.lit(gamma), F.col("bin")) * F.lit(2 / (gamma + 1))
    s = sketch.withColumn("v", F.when(F.col("sign") == 0, 0.0).otherwise(F.col("sign") * mid))
    every = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    s = s.withColumns({"upto": F.sum("n").over(every.orderBy("v")), "n_all": F.sum("n").over(every)})
    per = s.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
    hit = per.where(F.col("upto") >= F.greatest(F.ceil(F.col("q") * F.col("n_all")), F.lit(1)))
    return hit.groupBy(*keys, "q").agg(F.min("v").alias("estimate"), F.max("n_all").alias("n"))


def distinct_sketch(df: DataFrame, value: str, keys: Sequence[str] = (), lg_k: int = 12) -> DataFrame:
    """keys, sketch: HyperLogLog of the distinct values (2^lg_k registers: a
    standard error of about 1.04 / sqrt(2^lg_k))."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value), lg_k).alias("sketch"))


def merge_distinct(sketch: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return sketch.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimate(sketch: DataFrame, out: str = "estimate") -> DataFrame:
    return sketch.withColumn(out, F.hll_sketch_estimate("sketch")).drop("sketch")
