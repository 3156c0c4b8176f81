"""SCN-* counterfactual shocks and BRD-* distributional benchmarks."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from panelkit.operators.relational import union_all
from panelkit.operators.stats import scenario_means


def shock(df: DataFrame, deltas: Mapping[str, float]) -> DataFrame:
    """SCN-1: named features shifted, the rest unchanged."""
    return df.withColumns({c: F.col(c) + F.lit(float(d)) for c, d in deltas.items()})


def score_scenario(model: PipelineModel, df: DataFrame, deltas: Mapping[str, float],
                   keep: Sequence[str] = ()) -> DataFrame:
    """SCN-2: baseline and shocked predictions of the same rows in one pass:
    the shocked feature columns are computed next to the originals and the
    model is applied twice with different input columns (no join)."""
    assembler, est = model.stages[0], model.stages[-1]
    feats = assembler.getInputCols()
    wide = shock(df.withColumns({f"_s_{c}": F.col(c) for c in feats}), {f"_s_{c}": d for c, d in deltas.items() if c in feats})
    base = assembler.copy({assembler.outputCol: "_fb"}).transform(wide)
    both = assembler.copy({assembler.inputCols: [f"_s_{c}" for c in feats], assembler.outputCol: "_fs"}).transform(base)
    both = est.copy({est.featuresCol: "_fb", est.predictionCol: "baseline"}).transform(both)
    both = est.copy({est.featuresCol: "_fs", est.predictionCol: "scenario"}).transform(both)
    return both.select(*keep, "baseline", "scenario", (F.col("scenario") - F.col("baseline")).alias("delta"))


def compare_scenarios(models: Mapping[str, PipelineModel], df: DataFrame, deltas: Mapping[str, float],
                      digits: int = 3) -> DataFrame:
    """SCN-3: mean baseline / scenario / delta / pct per model."""
    parts = [score_scenario(m, df, deltas).withColumn("model", F.lit(name)) for name, m in models.items()]
    return scenario_means(union_all(parts), ["model"], digits)


def extrapolation(df: DataFrame, deltas: Mapping[str, float]) -> DataFrame:
    """SCN-4: per shocked feature the observed range, the shocked maximum,
    the out-of-range flag and the count of rows the shock pushes past the
    observed maximum. The maximum enters as a scalar subquery, so this is
    one aggregate over the table (no window over all rows, no join)."""
    aggs = []
    for c, d in deltas.items():
        mx = df.select(F.max(c)).scalar()
        aggs.append(F.struct(F.lit(c).alias("feature"), F.min(c).alias("observed_min"),
                             F.max(c).alias("observed_max"), (F.max(c) + float(d)).alias("shocked_max"),
                             (F.max(c) + float(d) > F.max(c)).alias("out_of_range"),
                             F.count_if(F.col(c) + float(d) > mx).alias("rows_out_of_range")))
    return df.agg(F.array(*aggs).alias("_x")).select(F.explode("_x").alias("_x")).select("_x.*")


def scenario_grid(ranges: Mapping[str, tuple[float, float, float]], model: PipelineModel,
                  spark, share: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """SCN-5: batch-score an input grid. Each axis is an integer ``sequence``
    scaled by its step (no float drift); axes are generated with successive
    ``explode`` projections. ``share`` maps an axis onto extra feature
    columns that take the same value (one rate for both lags)."""
    df = spark.range(1).drop("id")
    for name, (lo, hi, step) in ranges.items():
        lo_c = lo if isinstance(lo, Column) else F.lit(float(lo))
        hi_c = hi if isinstance(hi, Column) else F.lit(float(hi))
        n = F.round((hi_c - lo_c) / F.lit(float(step))).cast("int")
        df = (df.withColumn("_i", F.explode(F.sequence(F.lit(0), n)))
                .withColumn(name, F.col("_i") * F.lit(float(step)) + lo_c).drop("_i"))
    for src, targets in (share or {}).items():
        df = df.withColumns({t: F.col(src) for t in targets})
    return model.transform(df).drop("features")


def mortgage_benchmark(prices: DataFrame, price: str, time: str, keys: Sequence[str] = (),
                       ltv: float = 0.75, shock_pp: float = 1.0, fallback_price: float | None = None) -> DataFrame:
    """BRD-1: latest average price per key -> balance = price x ltv and the
    extra annual cost of a ``shock_pp`` point rate rise, each rounded to 0
    from the unrounded price. Unkeyed, ``fallback_price`` is used when the
    source has no usable row (``source`` tells which one was used)."""
    latest = prices.where(F.col(price).isNotNull()).groupBy(*keys).agg(
        F.max_by(F.col(price), F.col(time)).alias("price"), F.max(time).alias("as_of"))
    if fallback_price is not None and not keys:
        latest = latest.select(F.coalesce("price", F.lit(float(fallback_price))).alias("price"), "as_of",
                               F.when(F.col("price").isNull(), "fallback").otherwise("source").alias("source"))
    return latest.withColumns({
        "balance": F.round(F.col("price") * ltv, 0),
        "extra_annual_cost": F.round(F.col("price") * ltv * (shock_pp / 100.0), 0)})


def burden_by_group(income: DataFrame, cost: Column, income_col: str = "income", digits: int = 2,
                    out: str = "burden_share") -> DataFrame:
    """BRD-2: cost / income x 100 per group (NULL for zero income)."""
    return income.withColumn(out, F.round(F.try_divide(cost, F.col(income_col)) * 100, digits))
