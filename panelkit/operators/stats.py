"""AGG-*: grouped statistics, correlations, quantiles, histograms."""

from __future__ import annotations

from itertools import combinations
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.operators.series import global_cumsum, global_rank, join_on_keys


def group_mean(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """AGG-1."""
    return df.groupBy(*keys).agg(F.avg(col).alias(out or f"mean_{col}"))


def group_stats(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """AGG-2: mean, min, max renamed."""
    return df.groupBy(*keys).agg(F.avg(col).alias("mean"), F.min(col).alias("min"), F.max(col).alias("max"))


def label_counts(df: DataFrame, keys: Sequence[str], label: str, labels: Sequence[str],
                 extra: Sequence[Column] = ()) -> DataFrame:
    """AGG-3/AGG-4: counts per label (0 when absent) in the same aggregate."""
    counts = [F.count_if(F.col(label) == F.lit(v)).alias(f"{v}_count") for v in labels]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), *extra, *counts)


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], groups: Sequence[str] = (),
                    prefix: str = "q") -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / SQL
    ``quantile_cont``) without collecting any group's values into one task.

    Values are first counted per (group, value) (map-side combine: a
    low-cardinality measure collapses to a handful of rows whatever the
    table size), then a distributed running count over the sorted distinct
    values gives each value its position range. For n values and quantile
    q: h = (n - 1) q, result = v[floor h] + (h - floor h)(v[ceil h] -
    v[floor h]) with 0-based positions; only the rows covering those
    positions survive the filter.
    """
    groups = list(groups)
    vals = df.select(*groups, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    counts = vals.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_w"))
    cum = global_cumsum(counts, ["_v"], "_w", groups=groups, out="_cum").withColumnRenamed("_cum_total", "_n")
    hs = [(F.col("_n") - 1) * F.lit(float(q)) for q in qs]
    los = [F.floor(h) + 1 for h in hs]
    his = [F.ceil(h) + 1 for h in hs]

    def covers(pos):
        return (F.col("_cum") - F.col("_w") < pos) & (pos <= F.col("_cum"))

    keep = F.lit(False)
    for lo, hi in zip(los, his):
        keep = keep | covers(lo) | covers(hi)
    aggs = []
    for i, (h, lo, hi) in enumerate(zip(hs, los, his)):
        vlo = F.max(F.when(covers(lo), F.col("_v")))
        vhi = F.max(F.when(covers(hi), F.col("_v")))
        frac = F.max(h - F.floor(h))
        aggs.append((vlo + frac * (vhi - vlo)).alias(f"{prefix}{i}"))
    return cum.where(keep).groupBy(*groups).agg(*aggs)


def _mean(c: str, exact_digits: int | None) -> Column:
    if exact_digits is None:
        return F.avg(c)
    # exact integer sum of a short-decimal measure (units of 10^-digits),
    # then plain divisions: independent of summation order and partitioning
    scale = float(10 ** exact_digits)
    return F.sum(F.round(F.col(c) * F.lit(scale)).cast("long")) / F.lit(scale) / F.count(c)


def profile(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), digits: int | None = None,
            exact_digits: int | None = None) -> DataFrame:
    """AGG-5 / SET-7: count, mean, std (ddof=1), min, exact median, max per
    column, one row per column (long form via ``unpivot``)."""
    long = df.unpivot(list(keys), list(cols), "column", "value").where(F.col("value").isNotNull())
    g = [*keys, "column"]
    basic = long.groupBy(*g).agg(F.count("value").alias("count"), _mean("value", exact_digits).alias("mean"),
                                 F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                 F.max("value").alias("max"))
    med = exact_quantiles(long, "value", [0.5], groups=g, prefix="median").withColumnRenamed("median0", "median")
    out = join_on_keys(basic, med, g, "left")
    if digits is not None:
        out = out.withColumns({c: F.round(c, digits) for c in (("std", "median") if exact_digits is not None else ("mean", "std", "median"))})
    return out


def describe(df: DataFrame, col: str, keys: Sequence[str] = (), exact_digits: int | None = None) -> DataFrame:
    """AGG-6: count, mean, std, min, 25/50/75 % (linear), max."""
    basic = df.groupBy(*keys).agg(F.count(col).alias("count"), _mean(col, exact_digits).alias("mean"),
                                  F.stddev_samp(col).alias("std"), F.min(col).alias("min"),
                                  F.max(col).alias("max"))
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], groups=keys, prefix="q")
    q = q.withColumnsRenamed({"q0": "p25", "q1": "p50", "q2": "p75"})
    if keys:
        return join_on_keys(basic, q, list(keys), "left")
    three = q.select(F.struct("p25", "p50", "p75")).scalar()  # one subquery for all quantiles
    return basic.withColumns({c: three[c] for c in ("p25", "p50", "p75")})


def value_counts(df: DataFrame, col: str, preferred: Sequence[str] = (), missing: str = "unknown") -> DataFrame:
    """AGG-7: rows per label, NULL -> 'unknown'; ``order_rank`` orders by the
    preferred list first, then by count desc, then label."""
    lab = F.coalesce(F.col(col).cast("string"), F.lit(missing))
    counts = df.groupBy(lab.alias("label")).agg(F.count(F.lit(1)).alias("count"))
    pos = F.array_position(F.array(*[F.lit(p) for p in preferred]), F.col("label")) if preferred else F.lit(0)
    # preferred labels first (in list order), then count desc, then label;
    # ranked with the distributed global rank, so a high-cardinality column
    # does not put every label into one task
    keyed = counts.withColumns({"_pref": F.when(pos > 0, pos).otherwise(F.lit(len(preferred) + 1)).cast("int"),
                                "_negc": -F.col("count")})
    ranked = global_rank(keyed, ["_pref", "_negc", "label"], rank_col="order_rank")
    return ranked.withColumn("order_rank", F.col("order_rank").cast("int")).drop("_pref", "_negc")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """AGG-8."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def coverage(df: DataFrame, time: Column, keys: Sequence[str] = ()) -> DataFrame:
    """AGG-9 / AGG-17: 'min to max' text ('no rows' when empty), plus the
    distinct-period count and whether periods are unique."""
    return df.groupBy(*keys).agg(
        F.when(F.min(time).isNull(), F.lit("no rows"))
         .otherwise(F.concat_ws(" to ", F.min(time), F.max(time))).alias("coverage"),
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(time).alias("distinct_periods"),
        (F.count_distinct(time) == F.count(F.lit(1))).alias("unique_periods"))


def argmax_row(df: DataFrame, metric: str, time: str | Sequence[str], keys: Sequence[str] = (), cols: Sequence[str] = (),
               largest: bool = True, prefix: str = "max_") -> DataFrame:
    """AGG-10: the row of the first maximum (or minimum) of ``metric``;
    the earliest ``time`` (a column or several) wins ties and missing metrics are skipped (like
    idxmax). The ordering struct negates the metric, not the time, so any
    orderable time type works without a time-zone conversion."""
    cols = list(cols) or [c for c in df.columns if c not in keys]
    r = argmax_agg(metric, [time] if isinstance(time, str) else list(time), cols, largest)
    return (df.where(F.col(metric).isNotNull()).groupBy(*keys).agg(r.alias("_r"))
              .select(*keys, *[F.col(f"_r.{c}").alias(f"{prefix}{c}") for c in cols]))


def argmax_agg(metric: str, ties: Sequence[str], cols: Sequence[str], largest: bool = True) -> Column:
    """AGG-10 as an aggregate: ``cols`` of the row with the largest (or
    smallest) ``metric``; the smallest ``ties`` win, missing metrics are
    skipped."""
    m = -F.col(metric) if largest else F.col(metric)
    return F.min_by(F.struct(*cols), F.when(F.col(metric).isNotNull(), F.struct(m.alias("_m"), *ties)))


def _pearson(a: str, b: str) -> Column:
    # F.corr divides by zero on a constant column under ANSI mode.
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def pearson_matrix(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """AGG-11: all unordered pairs (a < b by position) over complete rows, long form."""
    complete = df.dropna(subset=list(cols))
    pairs = list(combinations(cols, 2))
    aggs = [_pearson(a, b).alias(f"{a}__{b}") for a, b in pairs]
    wide = complete.groupBy(*keys).agg(*aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("r"))
                                for a, b in pairs]))
    out = wide.select(*keys, stack.alias("_p")).select(*keys, "_p.*")
    return out.withColumn("r", F.round("r", digits)) if digits is not None else out


def average_rank(df: DataFrame, col: str, keys: Sequence[str] = (), out: str | None = None,
                 method: str = "distributed") -> DataFrame:
    """Average rank of tied values (1-based; ties share the mean of their
    positions), per key. NULL values get a NULL rank.

    ``distributed`` (default): rows are counted per (key, value) map-side,
    a distributed running count over the sorted distinct values gives
    rank = cum - (ties - 1) / 2, and the ranks are joined back (broadcast
    when small). ``window``: rank() + (ties - 1) / 2 with windows, for
    period-grain frames only (one key's periods per task)."""
    out = out or f"{col}_rank"
    if method == "window":
        o = F.col(col).asc_nulls_last()  # missing values do not take positions
        w = Window.partitionBy(*keys).orderBy(o) if keys else Window.orderBy(o)
        ties = Window.partitionBy(*keys, col)
        r = F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0
        return df.withColumn(out, F.when(F.col(col).isNotNull(), r))
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_w"))
    cum = global_cumsum(counts, [col], "_w", groups=list(keys), out="_cum")
    ranks = cum.select(*keys, col, (F.col("_cum") - (F.col("_w") - 1) / 2.0).alias(out))
    return join_on_keys(df, ranks, [*keys, col], "left")


def spearman_matrix(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), digits: int | None = None,
                    method: str = "distributed") -> DataFrame:
    """AGG-12: Pearson of average ranks over complete rows."""
    ranked = df.dropna(subset=list(cols))
    for c in cols:
        ranked = average_rank(ranked, c, keys, out=f"_rk_{c}", method=method)
    ranked = ranked.select(*keys, *[F.col(f"_rk_{c}").alias(c) for c in cols])
    return pearson_matrix(ranked, cols, keys, digits)


def rank_linear_gap(df: DataFrame, cols: Sequence[str], tol: float = 0.2, keys: Sequence[str] = (),
                    digits: int = 4, method: str = "distributed") -> DataFrame:
    """AGG-13: pairs where |Pearson - Spearman| > tol (each pair once)."""
    p = pearson_matrix(df, cols, keys).withColumnRenamed("r", "pearson")
    s = spearman_matrix(df, cols, keys, method=method).withColumnRenamed("r", "spearman")
    j = join_on_keys(p, s, [*keys, "a", "b"])
    return (j.where(F.abs(F.col("pearson") - F.col("spearman")) > tol)
             .select(*keys, "a", "b", F.round("pearson", digits).alias("pearson"),
                     F.round("spearman", digits).alias("spearman"),
                     F.round(F.col("pearson") - F.col("spearman"), digits).alias("gap")))


def histogram(df: DataFrame, col: str, bins: int = 12, keys: Sequence[str] = ()) -> DataFrame:
    """AGG-15: equal-width bins over [min, max], last bin right-closed,
    missing dropped; lo == hi puts everything in bin 1. The bounds are one
    row per key."""
    x = df.select(*keys, F.col(col).alias("_x")).where(F.col("_x").isNotNull())
    b = x.groupBy(*keys).agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    if keys:
        j = join_on_keys(x, b, list(keys))
    else:  # both bounds enter as one scalar subquery (one scan)
        lohi = b.select(F.struct("lo", "hi")).scalar()
        j = x.withColumns({"lo": lohi["lo"], "hi": lohi["hi"]})
    width = F.col("hi") - F.col("lo")
    raw = F.floor((F.col("_x") - F.col("lo")) / width * bins) + 1
    j = j.withColumn("bin", F.when(width == 0, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int"))
    return (j.groupBy(*keys, "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
             .withColumns({"bin_lo": F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / bins,
                           "bin_hi": F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins})
             .drop("lo", "hi"))


def sigma_outliers(df: DataFrame, cols: Sequence[str], k: float = 3.0, keys: Sequence[str] = ()) -> DataFrame:
    """AGG-16: per column (and key) the mean +- k*std bounds (ddof=1) and the
    count of rows strictly outside; nothing is removed."""
    long = df.unpivot(list(keys), list(cols), "column", "value").where(F.col("value").isNotNull())
    g = [*keys, "column"]
    stats = long.groupBy(*g).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    stats = stats.withColumns({"lower": F.col("mean") - k * F.col("std"), "upper": F.col("mean") + k * F.col("std")})
    j = join_on_keys(long, stats, g)
    return (j.groupBy(*g, "lower", "upper")
             .agg(F.count_if((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).alias("outliers")))


def regression_metrics(df: DataFrame, y: str, yhat: str, keys: Sequence[str] = (), digits: int | None = 3) -> DataFrame:
    """AGG-18: MAE, RMSE, R2 = 1 - SSres/SStot (NULL when SStot = 0)."""
    err = F.col(yhat) - F.col(y)
    sst = F.var_pop(y) * F.count(y)
    m = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull()).groupBy(*keys).agg(
        F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
        (1 - F.try_divide(F.sum(err * err), F.when(sst != 0, sst))).alias("r2"),
        F.count(F.lit(1)).alias("n_rows"))
    if digits is not None:
        m = m.withColumns({c: F.round(c, digits) for c in ("mae", "rmse", "r2")})
    return m


def scenario_means(scores: DataFrame, keys: Sequence[str] = ("model",), digits: int = 3) -> DataFrame:
    """AGG-19: mean baseline, scenario, delta and delta / baseline x 100."""
    return scores.groupBy(*keys).agg(
        F.round(F.avg("baseline"), digits).alias("mean_baseline"),
        F.round(F.avg("scenario"), digits).alias("mean_scenario"),
        F.round(F.avg("delta"), digits).alias("mean_delta"),
        F.round(F.try_divide(F.avg("delta"), F.avg("baseline")) * 100, digits).alias("pct_change"),
        F.count(F.lit(1)).alias("n_rows"))


def pivot_wide(df: DataFrame, index: Sequence[str], col: str, value: str, values: Sequence,
               name=lambda v: str(v), check_unique: bool = True) -> DataFrame:
    """AGG-20: rows -> columns with an explicit value list (no extra job);
    duplicate (index, column) pairs and values outside the list raise."""
    if check_unique:
        dup = df.groupBy(*index, col).count().where("count > 1").limit(1)
        if not dup.isEmpty():
            raise ValueError("duplicate (index, column) pairs in pivot input")
    other = df.where(~F.coalesce(F.col(col).isin(list(values)), F.lit(False))).select(col).limit(1).collect()
    if other:
        raise ValueError(f"value {other[0][0]!r} of {col} is not in the pivot list")
    p = df.groupBy(*index).pivot(col, list(values)).agg(F.first(value))
    return p.withColumnsRenamed({str(v): name(v) for v in values})


def extremes_ratio(df: DataFrame, group: str, value: str, lo, hi, keys: Sequence[str] = ()) -> DataFrame:
    """AGG-22: value of group ``lo`` over value of group ``hi``."""
    return df.groupBy(*keys).agg(F.try_divide(F.max(F.when(F.col(group) == lo, F.col(value))),
                                              F.max(F.when(F.col(group) == hi, F.col(value)))).alias("ratio"))
