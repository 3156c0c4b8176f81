"""QC-*: table contracts and data-quality metrics.

All metrics of one contract are computed in a single aggregate; the
``validate`` verdict is the only place that brings scalars to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from panelkit.operators.relational import except_columns


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class TableContract:
    name: str
    required: Sequence[str]
    keys: Sequence[str] = ()
    numeric: Sequence[str] = ()
    constants: Mapping[str, object] = field(default_factory=dict)
    month_column: str | None = None
    structural: Mapping[str, Column] = field(default_factory=dict)
    max_missing: Mapping[str, int] = field(default_factory=dict)


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """QC-1."""
    missing = except_columns(required, df)
    if missing:
        raise ContractError(f"missing columns: {missing}")


def no_month(col: str) -> Column:
    """QC-2 condition: the value is not 'yyyy-MM'. Count it for a metric."""
    return F.col(col).isNull() | F.try_to_date(F.col(col), "yyyy-MM").isNull() | (F.length(F.col(col)) != 7)


def bad_months(df: DataFrame, col: str, limit: int = 5) -> DataFrame:
    """QC-2: up to ``limit`` values that are not 'yyyy-MM', for a message."""
    return df.where(no_month(col)).select(col).limit(limit)


def require_months(df: DataFrame, col: str) -> DataFrame:
    """QC-2 as a gate: raises with up to five values that are no month, else
    returns the frame with the column formatted 'yyyy-MM'. Values may also be
    'yyyy-M' or carry a day."""
    month = F.coalesce(F.try_to_date(F.col(col), "yyyy-M"), F.try_to_date(F.col(col), "yyyy-M-d"))
    bad = [r[0] for r in df.where(month.isNull()).select(F.col(col).cast("string")).limit(5).collect()]
    if bad:
        raise ContractError(f"{col} has values that are no month: {bad}")
    return df.withColumn(col, F.date_format(month, "yyyy-MM"))


def require_numeric(df: DataFrame, cols: Sequence[str]) -> None:
    """QC-3."""
    wrong = [f.name for f in df.schema.fields if f.name in cols and not isinstance(f.dataType, NumericType)]
    if wrong:
        raise ContractError(f"non-numeric columns: {wrong}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """QC-4: second and later occurrences of each key (one-row result)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
              .agg(F.count(F.lit(1)).alias("distinct_keys"),
                   F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
                   F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates")))


def other_values(col: str, allowed: Sequence) -> Column:
    """QC-5 / QC-8 metric: how many non-missing values are not allowed."""
    return F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed)))


def allowed_values(df: DataFrame, col: str, allowed: Sequence) -> DataFrame:
    """QC-8: rows whose value is outside the allowed set (NULL excluded)."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed)))


def observe_counts(df: DataFrame, name: str = "rows"):
    """AGG-21 inside a running job: the row count is collected as a side
    metric of the next action (no second scan). Returns (df, observation)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def missingness(df: DataFrame, cols: Sequence[str] | None = None,
                structural: Mapping[str, Column] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """QC-6: per column total / structural / accidental missing counts.

    structural = missing AND the column's rule holds (a NULL rule counts as
    false); accidental = total - structural. One aggregate, then ``unpivot``.
    """
    cols = list(cols or [c for c in df.columns if c not in keys])
    structural = dict(structural or {})
    aggs = []
    for c in cols:
        miss = F.col(c).isNull()
        if c in df.schema.fieldNames() and df.schema[c].dataType.typeName() in ("double", "float"):
            miss = miss | F.isnan(F.col(c))
        rule = F.coalesce(structural.get(c, F.lit(False)), F.lit(False))
        aggs += [F.count_if(miss).alias(f"{c}__total"), F.count_if(miss & rule).alias(f"{c}__structural")]
    wide = df.groupBy(*keys).agg(*aggs)
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__total").alias("total"),
                                      F.col(f"{c}__structural").alias("structural")) for c in cols]))
    out = wide.select(*keys, st.alias("_m")).select(*keys, "_m.*")
    return out.withColumn("accidental", F.col("total") - F.col("structural"))


def missing_over_limit(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """QC-7: columns with more missing values than allowed."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in limits])
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing"),
                                      F.lit(n).alias("limit")) for c, n in limits.items()]))
    return counts.select(st.alias("_m")).select("_m.*").where(F.col("missing") > F.col("limit"))


def validate(df: DataFrame, contract: TableContract, raise_on_error: bool = True, cols: Sequence[str] | None = None) -> dict:
    """QC-9: run QC-1..7 + coverage + row count in one aggregate pass and
    return a summary dict (rows, duplicates, coverage, violations, and the
    missing counts of ``cols``: total / structural / accidental)."""
    require_columns(df, contract.required)
    require_numeric(df, contract.numeric)
    aggs = [F.count(F.lit(1)).alias("rows")]
    if contract.month_column:
        m = F.col(contract.month_column)
        aggs += [F.min(m).alias("first"), F.max(m).alias("last"),
                 F.count_if(F.try_to_date(m, "yyyy-MM").isNull() | (F.length(m) != 7)).alias("bad_months")]
    for c in contract.constants:
        aggs += [other_values(c, [contract.constants[c]]).alias(f"other__{c}"), F.count(c).alias(f"given__{c}"),
                 F.min(c).alias(f"lo__{c}"), F.max(c).alias(f"hi__{c}")]
    for c in contract.max_missing:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"miss__{c}"))
    row = df.agg(*aggs).first().asDict()
    dup = duplicate_keys(df, contract.keys).first()["duplicates"] if contract.keys else 0
    problems = []
    if dup:
        problems.append(f"{dup} duplicate keys on {list(contract.keys)}")
    if contract.month_column and row["bad_months"]:
        problems.append(f"{row['bad_months']} malformed months")
    for c, v in contract.constants.items():
        if row[f"other__{c}"] or not row[f"given__{c}"]:
            problems.append(f"{c} has {row[f'other__{c}']} of {row[f'given__{c}']} values other than {v!r}, from {row[f'lo__{c}']!r} to {row[f'hi__{c}']!r}")
    for c, n in contract.max_missing.items():
        if row[f"miss__{c}"] > n:
            problems.append(f"{c} has {row[f'miss__{c}']} missing > {n}")
    report = {"name": contract.name, "rows": row["rows"], "duplicates": dup,
              "coverage": (f"{row['first']} to {row['last']}" if contract.month_column and row["rows"]
                           else ("no rows" if contract.month_column else None)),
              "problems": problems,
              "missing": {r["column"]: (r["total"], r["structural"], r["accidental"])
                          for r in missingness(df, cols or [c for c in df.columns if c not in contract.keys], contract.structural).collect()}}
    if problems and raise_on_error:
        raise ContractError(f"{contract.name}: " + "; ".join(problems))
    return report


def expect_rows(df: DataFrame, expected: int | None = None, at_least: int | None = None) -> int:
    """AGG-21 check: the row count (one job) must equal ``expected`` and/or
    reach ``at_least``; returns the count."""
    n = df.count()
    if expected is not None and n != expected:
        raise ContractError(f"expected {expected} rows, got {n}")
    if at_least is not None and n < at_least:
        raise ContractError(f"expected at least {at_least} rows, got {n}")
    return n


def validation_report(df: DataFrame, contract: TableContract) -> tuple[DataFrame, DataFrame]:
    """QC-9 as tables (nothing collected): one summary row (dataset, rows,
    duplicate keys, coverage, malformed months) and the long missingness
    table with the contract's structural rules."""
    keys = list(contract.keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if keys else None
    dup = (per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))
           if keys else df.sparkSession.range(1).select(F.lit(0).cast("long").alias("duplicates")))
    aggs = [F.lit(contract.name).alias("dataset"), F.count(F.lit(1)).alias("rows")]
    if contract.month_column:
        m = F.col(contract.month_column)
        aggs += [F.when(F.count(F.lit(1)) == 0, F.lit("no rows"))
                  .otherwise(F.concat_ws(" to ", F.min(m), F.max(m))).alias("coverage"),
                 F.count_if(F.try_to_date(m, "yyyy-MM").isNull() | (F.length(m) != 7)).alias("bad_months")]
    summary = df.agg(*aggs).withColumn("duplicates", dup.select("duplicates").scalar())
    cols = [c for c in df.columns if c not in keys]
    return summary, missingness(df, cols, structural=dict(contract.structural))


def expected_value(actual: Column | str, expected: Column | str, digits: int) -> Column:
    """QC-10: whether a frozen number is reproduced at ``digits`` places (two
    missing numbers agree)."""
    a, e = (F.round(F.col(x) if isinstance(x, str) else x, digits) for x in (actual, expected))
    return a.eqNullSafe(e)


class CleanLog:
    """QC-11 with AGG-21: row counts of a cleaning plan, observed while it runs.
    ``rows`` attaches a count (and further metrics) to a stage of the plan; after
    the action that runs the plan, ``entry`` has the numbers, from that job."""

    def __init__(self, dataset: str):
        self.dataset, self.seen = dataset, {}

    @classmethod
    def off(cls) -> CleanLog:
        """A log that observes nothing."""
        own = cls("")
        own.rows = lambda df, stage, **metrics: df
        return own

    def rows(self, df: DataFrame, stage: str, **metrics: Column) -> DataFrame:
        from pyspark.sql import Observation
        self.seen[stage] = Observation()
        return df.observe(self.seen[stage], F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])

    def entry(self) -> dict:
        """Rows in and out, unparsable ones (a date or a number missing),
        duplicates removed, coverage. Waits for the action."""
        got = {stage: o.get for stage, o in self.seen.items()}
        out = got["out"]
        return {"dataset": self.dataset, "rows_in": got["in"]["rows"], "unparsable": got["parsed"]["unparsable"],
                "duplicates": got["parsed"]["rows"] - got["parsed"]["dropped"] - got["kept"]["rows"], "rows_out": out["rows"],
                "coverage": f"{out['first']} to {out['last']}" if out["rows"] else "no rows"}


def observed_log(spark, logs: Sequence[CleanLog]) -> DataFrame:
    """QC-11: one row per cleaning log whose plan has run."""
    names = ["dataset", "rows_in", "unparsable", "duplicates", "rows_out", "coverage"]
    return spark.createDataFrame([tuple(x.entry()[n] for n in names) for x in logs],
                                 "dataset string, rows_in long, unparsable long, duplicates long, rows_out long, coverage string")


def clean_log(spark, entries: Sequence[Mapping]) -> DataFrame:
    """QC-11: rows before/after, duplicates removed, coverage per dataset."""
    schema = "dataset string, rows_in long, rows_out long, duplicates long, coverage string"
    return spark.createDataFrame([tuple(e.get(k) for k in ("dataset", "rows_in", "rows_out", "duplicates", "coverage"))
                                  for e in entries], schema)
