"""PRJ-*, FLT-*, SET-*, JN-1/2/4..8: projections, predicates, joins, reshaping."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- projections
def project(df: DataFrame, mapping: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """PRJ-1: select + rename + reorder; mapping is {source: target} or names."""
    if isinstance(mapping, Mapping):
        return df.select(*[F.col(s).alias(t) for s, t in mapping.items()])
    return df.select(*mapping)


def with_literals(df: DataFrame, **consts) -> DataFrame:
    """PRJ-2: stamp constant metadata columns."""
    return df.withColumns({k: F.lit(v) for k, v in consts.items()})


def coerce_numeric(df: DataFrame, cols: Iterable[str], to: str = "double") -> DataFrame:
    """PRJ-3: text -> number, unparsable -> NULL; NaN normalised to NULL."""
    out = {}
    for c in cols:
        v = F.trim(F.col(c).cast("string")).try_cast(to)
        out[c] = F.when(~F.isnan(v), v) if to in ("double", "float") else v
    return df.withColumns(out)


def derive(df: DataFrame, **exprs: Column) -> DataFrame:
    """PRJ-4: arithmetic columns (use ``try_divide`` for ratios)."""
    return df.withColumns(exprs)


def display_labels(df: DataFrame, group: str, money: str, pct: str) -> DataFrame:
    """PRJ-5: 'D{n}', thousands-separated currency, 'x.x%'."""
    return df.withColumns({
        f"{group}_label": F.concat(F.lit("D"), F.col(group).cast("string")),
        f"{money}_label": F.concat(F.lit("£"), F.format_number(F.col(money), 0)),
        f"{pct}_label": F.format_string("%.1f%%", F.col(pct)),
    })


def cast_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """PRJ-6: strict-free casts (bad values -> NULL)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


# ------------------------------------------------------------------- filters
def filter_eq(df: DataFrame, col: str, value, require_rows: bool = False) -> DataFrame:
    """FLT-1; ``require_rows`` raises when nothing matches (one tiny job)."""
    out = df.where(F.col(col) == F.lit(value))
    if require_rows and out.isEmpty():
        raise ValueError(f"no rows with {col} == {value!r}")
    return out


def fullmatch(c, regex: str) -> Column:
    """FLT-2 predicate: whole-value regex match."""
    return _c(c).rlike(f"^(?:{regex})$")


# The label formats of the releases.
MONTHLY_LABEL = r"\d{4}\s[A-Z]{3}"
ANNUAL_LABEL = r"\d{4}(?:[-/]\d{2,4})?"


def filter_fullmatch(df: DataFrame, col: str, regex: str) -> DataFrame:
    return df.where(fullmatch(col, regex))


def ieq(c, value: str) -> Column:
    """FLT-3 predicate."""
    return F.lower(_c(c)) == F.lower(F.lit(value))


def filter_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """FLT-4: inclusive range."""
    return df.where(F.col(col).between(lo, hi))


def filter_in(df: DataFrame, col: str, values) -> DataFrame:
    """FLT-5: literal list -> ``isin``; a DataFrame of values -> semi join."""
    if isinstance(values, DataFrame):
        return df.join(values.select(F.col(values.columns[0]).alias(col)).distinct(), col, "left_semi")
    return df.where(F.col(col).isin(list(values)))


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """FLT-6."""
    return df.dropna(subset=list(cols) if cols else None)


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """FLT-7: missing and whitespace-only text dropped."""
    return df.where(F.coalesce(F.trim(F.col(col)), F.lit("")) != "")


def search_any_column(df: DataFrame, pattern: str, cols: Sequence[str] | None = None) -> DataFrame:
    """FLT-8: keep rows where any column, as text, matches ``pattern``
    (a regex, case-insensitive); NULL never matches."""
    cols = list(cols or df.columns)
    hit = reduce(lambda a, b: a | b,
                 [F.coalesce(F.col(c).cast("string").rlike(f"(?i){pattern}"), F.lit(False)) for c in cols])
    return df.where(hit)


def implausible(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """FLT-9: rows outside [lo, hi]; NULL never flagged."""
    return df.where(~F.col(col).between(lo, hi))


def threshold_rows(df: DataFrame, cond: Column, cols: Sequence[str] | None = None) -> DataFrame:
    """FLT-10."""
    out = df.where(cond)
    return out.select(*cols) if cols else out


def phrase_hits(text: Column, phrases: Sequence[str]) -> Column:
    """Array of the phrases contained in ``text`` (literal containment)."""
    arr = F.array(*[F.lit(p) for p in phrases])
    return F.filter(arr, lambda p: F.contains(text, p))


# ---------------------------------------------------------------------- joins
def inner_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """JN-1: AQE chooses broadcast or sort-merge from runtime sizes."""
    return a.join(b, on, "inner")


def left_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """JN-2: missing stays missing."""
    return a.join(b, on, "left")


def mark_absent(df: DataFrame, ref: DataFrame, on: Sequence[str], flag: str = "absent") -> DataFrame:
    """JN-4: flag rows whose key is not in ``ref``'s key set."""
    keys = ref.select(*on).distinct().withColumn("_present", F.lit(True))
    return (df.join(keys, list(on), "left")
              .withColumn(flag, F.col("_present").isNull()).drop("_present"))


def lookup(df: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """JN-5: dictionary map of a key column; adaptive execution broadcasts
    the mapping if its measured bytes allow."""
    return df.join(mapping, key, "left")


def shared_periods(a: DataFrame, b: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """JN-6: restrict both sides to the keys they share."""
    common = a.select(*on).intersect(b.select(*on))
    return a.join(common, list(on), "left_semi"), b.join(common, list(on), "left_semi")


def aligned_arith(df: DataFrame, key: Sequence[str], period: str, value: str, p0, p1,
                  fn=lambda a, b: b / a) -> DataFrame:
    """JN-7: combine the values at two periods per key in one aggregate."""
    return (df.groupBy(*key)
              .agg(F.max(F.when(F.col(period) == p0, F.col(value))).alias("v0"),
                   F.max(F.when(F.col(period) == p1, F.col(value))).alias("v1"))
              .withColumn("result", fn(F.col("v0"), F.col("v1"))))


def versus_baseline(df: DataFrame, id_col: str, baseline_id: str,
                    lower_better: Sequence[str] = ("mae", "rmse"),
                    higher_better: Sequence[str] = ("r2",), digits: int = 3) -> DataFrame:
    """JN-8: improvement of each row over the baseline row (computed from the
    already rounded metrics); all NULL when the baseline row is absent.
    The baseline enters as one scalar subquery."""
    metrics = list(lower_better) + list(higher_better)
    base = df.where(F.col(id_col) == baseline_id)
    one = base.select(F.struct(*[F.max(m).alias(m) for m in metrics])).scalar()  # one subquery for all metrics
    out = df.withColumns({f"_b_{m}": one[m] for m in metrics})
    imp = {f"{m}_improvement": F.round(F.col(f"_b_{m}") - F.col(m), digits) for m in lower_better}
    imp.update({f"{m}_improvement": F.round(F.col(m) - F.col(f"_b_{m}"), digits) for m in higher_better})
    return out.withColumns(imp).drop(*[f"_b_{m}" for m in metrics])


# --------------------------------------------------------- sets / reshaping
def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """SET-1."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def intersect_keys(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SET-2."""
    return a.select(*cols).intersect(b.select(*cols))


def except_columns(required: Sequence[str], df: DataFrame) -> list[str]:
    """SET-3: required columns the frame lacks (metadata only, no job)."""
    have = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in have]


def concat_columns(df: DataFrame, **cols: Column) -> DataFrame:
    """SET-6: append computed columns row-aligned (a projection, no join)."""
    return df.withColumns(cols)


def distinct_rows(df: DataFrame) -> DataFrame:
    """SET-4."""
    return df.distinct()


def unpivot_columns(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "column",
                    value: str = "value", require_any: bool = True) -> DataFrame:
    """SET-5 / SET-7: wide -> long over the columns that exist; error if none."""
    present = [c for c in cols if c in df.columns]
    if require_any and not present:
        raise ValueError(f"none of {list(cols)} present")
    return df.unpivot(list(ids), present, name, value)
