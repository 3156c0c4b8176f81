"""CMP-*: composite analyses built from the operators (generic inputs)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.operators import relational as R
from panelkit.operators import series as S
from panelkit.operators import stats as A


def real_income_index(income: DataFrame, rate: DataFrame, base_year: int, years: Sequence[int] | None = None,
                      group: str = "decile", digits: int = 1) -> DataFrame:
    """CMP-6: AGG-1 rate -> WIN-4 price level -> FLT-5 years (all, unless a
    list is given) -> JN-5 lookup
    -> PRJ-4 deflate -> WIN-3 index to the base year, rounded."""
    level = S.price_level(rate, "rate", "year", base_year).select("year", "price_level")
    inc = R.filter_in(income, "year", years) if years is not None else income
    real = R.lookup(inc, level, "year").withColumn("real_income", F.col("income") / F.col("price_level"))
    out = S.index100(real, ["real_income"], "year", keys=[group], base_time=base_year)
    return out.select(group, "year", "price_level", F.round("real_income_index", digits).alias("real_index"))


def real_change(income: DataFrame, rate: DataFrame, base_year: int, start: int, end: int,
                group: str = "decile", digits: int = 1) -> DataFrame:
    """CMP-7: start vs end year deflated income, percent change per group."""
    level = S.price_level(rate, "rate", "year", base_year).select("year", "price_level")
    real = R.lookup(R.filter_in(income, "year", [start, end]), level, "year") \
            .withColumn("real_income", F.col("income") / F.col("price_level"))
    ch = R.aligned_arith(real, [group], "year", "real_income", start, end,
                         fn=lambda a, b: (b / a - 1) * 100)
    return ch.select(group, F.round("v0", 2).alias("start_real"), F.round("v1", 2).alias("end_real"),
                     F.round("result", digits).alias("real_change_pct"))


def pressure_gap(price: DataFrame, income: DataFrame, group: str = "decile") -> DataFrame:
    """CMP-8..10: price and income indexed to their first shared year; the gap
    at the last shared year and the growth of both since the base."""
    yrs_p, yrs_i = R.shared_periods(price, income, ["year"])
    # one scalar subquery for both bounds (a struct), so the inputs run once
    b = yrs_p.select(F.struct(F.min("year").alias("y0"), F.max("year").alias("y1"))).scalar()
    # scalar subqueries may not sit inside an aggregate: project them first
    p = yrs_p.withColumns({"_y0": b["y0"], "_y1": b["y1"]}).agg(F.struct(
        F.max(F.when(F.col("year") == F.col("_y0"), F.col("price"))).alias("p0"),
        F.max(F.when(F.col("year") == F.col("_y1"), F.col("price"))).alias("p1")).alias("_p"))
    i = yrs_i.withColumns({"_y0": b["y0"], "_y1": b["y1"]}).groupBy(group, "_y0", "_y1").agg(
        F.max(F.when(F.col("year") == F.col("_y0"), F.col("income"))).alias("i0"),
        F.max(F.when(F.col("year") == F.col("_y1"), F.col("income"))).alias("i1"))
    pv = p.select("_p").scalar()
    j = i.withColumns({"p0": pv["p0"], "p1": pv["p1"], "y0": F.col("_y0"), "y1": F.col("_y1")})
    price_idx = F.col("p1") / F.col("p0") * 100
    inc_idx = F.col("i1") / F.col("i0") * 100
    return j.select(group, F.col("y0").alias("base_year"), F.col("y1").alias("end_year"),
                    F.round(price_idx, 1).alias("price_index"), F.round(inc_idx, 1).alias("income_index"),
                    F.round(price_idx - inc_idx, 1).alias("gap"),
                    F.round(price_idx - 100, 2).alias("price_growth"),
                    F.round(inc_idx - 100, 2).alias("income_growth"))


def turning_points(series: DataFrame, time: str, *, rise_col: str, floor, peak_col: str, cut_col: str,
                   keys: Sequence[str] = ()) -> DataFrame:
    """CMP-11: first period ``rise_col`` is above ``floor`` (a number or a
    Column), the period of the first maximum of ``peak_col`` (earliest on
    ties) and the first period ``cut_col`` falls below its running maximum;
    one aggregate after a per-key running-max window."""
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(time) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fl = floor if isinstance(floor, Column) else F.lit(floor)
    s = series.withColumns({"_rmax": F.max(cut_col).over(w), "_floor": fl})
    return s.groupBy(*keys).agg(
        F.min(F.when(F.col(rise_col) > F.col("_floor"), F.col(time))).alias("first_rise"),
        F.min_by(F.col(time), F.struct(-F.col(peak_col), F.col(time))).alias("peak_time"),
        F.max(peak_col).alias("peak_value"),
        F.min(F.when(F.col(cut_col) < F.col("_rmax"), F.col(time))).alias("first_cut"))


def monthly_macro(base: DataFrame, inner: Sequence[DataFrame] = (), left: Sequence[DataFrame] = (),
                  key: str = "year_month", order: str | None = None, stamp: dict | None = None,
                  structural_for: Sequence[DataFrame] = (), validate_with=None):
    """CMP-5: align monthly series on ``key``: inner joins fix the shared
    window (JN-1), left joins attach context that may be missing (JN-2),
    optional keep-last per key (WIN-6) and literal metadata (PRJ-2).

    ``structural_for``: for each frame, its value columns count as
    structurally missing in months that frame never published (JN-4); the
    rules feed :func:`quality.missingness` / ``validate_with`` (a
    TableContract), which runs one aggregate pass and raises on violations.
    Returns (panel, missingness_table)."""
    from dataclasses import replace

    from panelkit.operators import quality as Q
    from panelkit.operators.series import keep_last

    panel = base
    for f in inner:
        panel = panel.join(f, key, "inner")
    for f in left:
        panel = panel.join(f, key, "left")
    if order:
        panel = keep_last(panel, [key], [order])
    if stamp:
        panel = R.with_literals(panel, **stamp)
    rules = {}
    for i, f in enumerate(structural_for):
        flag = f"_absent{i}"
        panel = R.mark_absent(panel, f, [key], flag=flag)
        rules.update({c: F.col(flag) for c in f.columns if c != key})
    flags = [c for c in panel.columns if c.startswith("_absent")]
    cols = [c for c in panel.columns if c != key and c not in flags]
    miss = Q.missingness(panel, cols, structural=rules)
    if validate_with is not None:  # the rules read the flags
        Q.validate(panel, replace(validate_with, structural=rules), cols=cols)
    return panel.drop(*flags), miss
