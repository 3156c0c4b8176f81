"""SRC-1..8 readers for statistical releases and the CMP-1..4 cleaning plans.

Schemas are declared at read (never inferred); many release files can be
read in one scan, each row keeping its file path and file-order position.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelkit.functions import dates as D
from panelkit.operators import relational as R
from panelkit.operators import series as S
from panelkit.operators.asof import asof_fill, visible_month
from panelkit.operators.quality import CleanLog
from panelkit.session import cut_lineage


class SchemaError(ValueError):
    pass


def read_table(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "csv", **opts) -> DataFrame:
    """SRC-1: headered CSV (or parquet/json) with a declared schema."""
    r = spark.read.schema(schema)
    if fmt == "csv":
        r = r.option("header", opts.pop("header", True)).option("escape", '"').option("multiLine", opts.pop("multiLine", False))
    return r.options(**opts).format(fmt).load(path)


def _placed(df: DataFrame) -> DataFrame:
    """df with ``file`` and ``line``, the place of a row in its file."""
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.withColumns({"file": F.col("_metadata.file_path"), "line": line})


def read_checked(spark: SparkSession, path: str, schema: StructType, **opts) -> tuple[DataFrame, DataFrame]:
    """SRC-1 with rejects: (rows that fit the declared schema, rejected records).
    A record with a value that cannot be read, or too few or too many of them, is
    kept as text with its ``file`` and ``line``. All columns are parsed in both
    frames, so that a record is judged alike whatever is selected from them."""
    whole = StructType([*schema.fields, StructField("_record", StringType())])
    r = _placed(read_table(spark, path, whole, mode="PERMISSIVE", columnNameOfCorruptRecord="_record", columnPruning=False, **opts))
    r = r.where(F.xxhash64(*schema.fieldNames()) >= -(1 << 63))  # always true: keeps all columns in the scan
    return (r.where(F.col("_record").isNull()).select(*schema.fieldNames(), "file", "line"),
            r.where(F.col("_record").isNotNull()).select("file", "line", F.col("_record").alias("record")))


RELEASE_SCHEMA = StructType([StructField("_c0", StringType()), StructField("_c1", StringType())])


def read_release(spark: SparkSession, path: str, ncols: int = 2) -> DataFrame:
    """SRC-2: headerless release export(s): metadata preamble plus annual,
    quarterly and monthly rows in one label column. Adds ``file`` and
    ``line``, a struct that orders rows for keep-last whatever way files are
    packed into splits: (8-digit stamp of the file name, file path, start of
    the split in the file, position in the split)."""
    schema = StructType([StructField(f"_c{i}", StringType()) for i in range(ncols)])
    df = spark.read.schema(schema).option("header", False).option("escape", '"').csv(path)
    file = F.col("_metadata.file_path")
    line = F.struct(F.regexp_extract(file, r"_(\d{8})(?=\.[^./]+$)", 1).alias("stamp"), file.alias("file"),
                    F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.withColumns({"file": file, "line": line})


def _title_rows(df: DataFrame, label_col: str, title_label: str) -> list:
    """The title row of each file (of the frame, if it has no ``file``): one
    row per file reaches the driver. Of several, the first in file order."""
    rows = df.where(F.lower(F.trim(F.col(label_col))) == title_label)
    if "line" in df.columns:
        by = ["file"] if "file" in df.columns else []
        rows = rows.groupBy(*by).agg(F.min_by(F.struct(*df.columns), "line").alias("_r")).select("_r.*")
        found = rows.collect()
    else:
        found = rows.limit(1).collect()
    if not found:
        raise SchemaError("no title row")
    return found


def _carried(df: DataFrame) -> list[str]:
    return [x for x in ("file", "line") if x in df.columns]


def select_series(df: DataFrame, title_substring: str, label_col: str = "_c0", title_label: str = "title") -> DataFrame:
    """SRC-3: pick the value column whose title row contains the text
    (case-insensitive, first match); error if none. Each file's own title row
    decides for its rows; a file without the series gives no rows."""
    value, found, ok = F.lit(None).cast("string"), F.lit(False), False
    for row in _title_rows(df, label_col, title_label):
        hit = next((c for c in df.columns if c not in (label_col, "file", "line")
                    and row[c] is not None and title_substring.lower() in str(row[c]).lower()), None)
        if hit is None:
            continue
        own = F.col("file") == row["file"] if "file" in df.columns else F.lit(True)
        value, found = F.when(own, F.col(hit)).otherwise(value), found | own
        ok = True
    if not ok:
        raise SchemaError(f"no series titled like {title_substring!r}")
    return df.where(found).select(F.col(label_col).alias("label"), value.alias("value"), *_carried(df))


def unpivot_series(df: DataFrame, titles: Sequence[str] | None = None, label_col: str = "_c0",
                   title_label: str = "title") -> DataFrame:
    """SRC-3 for wide exports holding many series: every value column
    becomes (title, label, value) rows, titled by its own file's title row;
    when ``titles`` is given, series are kept whose title contains any of
    them (case-insensitive)."""
    value_cols = [c for c in df.columns if c not in (label_col, "file", "line")]
    keep, names = _carried(df), {}
    for row in _title_rows(df, label_col, title_label):
        for c in value_cols:
            t = None if row[c] is None else str(row[c])
            if t is not None and (not titles or any(x.lower() in t.lower() for x in titles)):
                names[(row["file"] if "file" in keep else "") + "\n" + c] = t
    if not names:
        raise SchemaError(f"no series titled like {list(titles or [])!r}")
    long = df.unpivot([label_col, *keep], value_cols, "_col", "value")
    key = F.concat(F.col("file") if "file" in keep else F.lit(""), F.lit("\n"), F.col("_col"))
    title = F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), key)
    return long.select(title.alias("title"), F.col(label_col).alias("label"), "value", *keep).where(F.col("title").isNotNull())


def resolve_schema_variant(df: DataFrame, variants: Sequence[Mapping[str, str]]) -> DataFrame:
    """SRC-4: the first layout whose source columns are all present is
    renamed to the canonical names; error when none matches."""
    have = set(df.columns)
    for v in variants:
        if set(v).issubset(have):
            return df.withColumnsRenamed(dict(v))
    raise SchemaError(f"no accepted layout among {list(map(dict, variants))}; got {sorted(have)}")


def unify_variants(dfs: Sequence[DataFrame], variants: Sequence[Mapping[str, str]]) -> DataFrame:
    """SRC-4 across mixed files: each frame resolved, then a by-name union."""
    return R.union_all([resolve_schema_variant(d, variants) for d in dfs])


def read_variants(spark: SparkSession, path: str, variants: Sequence[Mapping[str, str]], columns: int | None = None,
                  width: int = 32) -> tuple[DataFrame, DataFrame]:
    """SRC-4 and SRC-5 over a folder of files in several layouts, in one scan:
    (rows under the canonical names with ``file`` and ``line``, rejected files).

    Every file's own header line tells its layout: the first line that holds all
    source columns of a variant. The places of the columns (one row per file)
    are joined to the lines of the file. A file without an accepted header, or
    whose header does not have ``columns`` cells when given, is rejected with the
    reason. ``width`` bounds the columns of a file; a wider header is rejected."""
    names = list(dict.fromkeys(c for v in variants for c in v.values()))
    raw = StructType([StructField(f"_c{i}", StringType()) for i in range(width + 1)])
    lines = _placed(spark.read.schema(raw).option("header", False).option("escape", '"').option("recursiveFileLookup", True).csv(path))
    lines = lines.select("file", "line", F.transform(F.array(*raw.fieldNames()), lambda c: F.trim(c)).alias("cells"))
    which, places = F.lit(None).cast("int"), F.lit(None).cast("array<int>")
    for i, v in reversed(list(enumerate(variants))):
        hit = F.size(F.array_intersect(F.array(*[F.lit(x) for x in v]), F.col("cells"))) == len(v)
        source = {c: x for x, c in v.items()}
        own = F.array(*[F.array_position("cells", source[c]).cast("int") if c in source else F.lit(0) for c in names])
        which, places = F.when(hit, i).otherwise(which), F.when(hit, own).otherwise(places)
    found = lines.withColumns({"variant": which, "places": places, "n_cells": F.size(F.filter("cells", lambda c: c.isNotNull()))})
    heads = found.groupBy("file").agg(F.min_by(F.struct("variant", "places", "n_cells", "line"), F.when(F.col("variant").isNotNull(), F.col("line"))).alias("head"))
    heads = heads.select("file", "head.*").withColumnRenamed("line", "head_line")
    reason = (F.when(F.col("variant").isNull(), "no accepted header").when(F.col("n_cells") > width, "too many columns")
              .when(F.lit(columns is not None) & (F.col("n_cells") != F.lit(columns or 0)), "unexpected number of columns"))
    heads = cut_lineage(heads.withColumn("reason", reason))
    body = lines.join(heads.where("reason IS NULL"), "file").where(F.col("line") > F.col("head_line"))
    value = lambda j: F.try_element_at("cells", F.when(F.get("places", F.lit(j)) > 0, F.get("places", F.lit(j))))
    return body.select(*[value(j).alias(c) for j, c in enumerate(names)], "file", "line"), heads.where("reason IS NOT NULL").select("file", "reason")


def expect_columns(df: DataFrame, names: Sequence[str], ignore: Sequence[str] = ("file", "line")) -> DataFrame:
    """SRC-5: reject an unexpected column count, then rename positionally."""
    data = [c for c in df.columns if c not in ignore]
    if len(data) != len(names):
        raise SchemaError(f"expected {len(names)} columns, got {len(data)}")
    return df.withColumnsRenamed(dict(zip(data, names)))


def normalise_headers(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """SRC-6: trim + casefold headers; error if any required one is missing."""
    norm = {c: c.strip().casefold() for c in df.columns}
    out = df.withColumnsRenamed(norm)
    missing = [r for r in required if r.strip().casefold() not in out.columns]
    if missing:
        raise SchemaError(f"missing columns {missing}")
    return out


def long_income(df: DataFrame, *, period: str, group: str, component: str, decile: str, value: str,
                group_value: str, component_value: str, latest: int = 5) -> DataFrame:
    """SRC-7: long annual layout -> (period, decile, value) for the newest
    ``latest`` periods: trim text, coerce numbers, filter the population,
    the component and deciles 1..10."""
    t = df.select(*[F.trim(F.col(c)).alias(c) for c in (period, group, component, decile)], F.col(value))
    num = F.regexp_extract(F.col(decile), r"(\d+)", 1).try_cast("int")
    t = t.withColumns({"decile": num, "value": F.trim(F.col(value).cast("string")).try_cast("double")})
    t = t.where(R.ieq(group, group_value) & R.ieq(component, component_value) & F.col("decile").between(1, 10))
    t = S.latest_n_periods(t, D.fiscal_period_start(period), latest)
    return t.select(F.col(period).alias("period"), "decile", "value")


def wide_income_to_long(df: DataFrame, period: str, decile_cols: Sequence[str], latest: int | None = None) -> DataFrame:
    """SRC-8: one row per period with ten decile columns -> (period, decile,
    value); decile = position 1..n of the column."""
    arr = F.array(*[F.struct(F.lit(i + 1).alias("decile"), F.col(c).cast("string").alias("v"))
                    for i, c in enumerate(decile_cols)])
    out = df.where(R.fullmatch(F.trim(F.col(period)), R.ANNUAL_LABEL)) \
            .select(F.trim(F.col(period)).alias("period"), F.explode(arr).alias("_d"))
    out = out.select("period", "_d.decile", F.trim("_d.v").try_cast("double").alias("value"))
    if latest:
        out = S.latest_n_periods(out, D.fiscal_period_start("period"), latest)
    return out


# ------------------------------------------------------------- CMP-1 .. 4
def clean_monthly_release(df: DataFrame, label: str = "label", value: str = "value", order: str = "line",
                          n_months: int = 60, keys: Sequence[str] = (), log: CleanLog | None = None, **stamp) -> DataFrame:
    """CMP-1: monthly rows ('2023 JAN') only, parsed, typed, de-duplicated
    keeping the last in file order, newest ``n_months``, stamped."""
    log = log or CleanLog.off()
    m = log.rows(df.where(R.fullmatch(F.trim(F.col(label)), R.MONTHLY_LABEL)), "in")
    m = m.withColumns({"_month": D.parse_month_label(label),
                       "_v": F.trim(F.col(value).cast("string")).try_cast("double")})
    m = log.rows(m, "parsed", unparsable=F.count_if(F.col("_month").isNull() | F.col("_v").isNull()), dropped=F.count_if(F.col("_month").isNull()))
    m = m.where(F.col("_month").isNotNull()).withColumn("year_month", D.year_month("_month"))
    m = m.select(*keys, "year_month", F.col("_v").alias("value"), F.col(order).alias("_order"))
    m = log.rows(S.keep_last(m, [*keys, "year_month"], ["_order"]).drop("_order"), "kept")
    m = S.latest_n(m, "year_month", n_months, keys=keys) if keys or n_months else m
    m = log.rows(m, "out", first=F.min("year_month"), last=F.max("year_month"))
    return R.with_literals(m, **stamp) if stamp else m


# The column names of the public files.
PRICE_VARIANTS = [
    {"Date": "date", "RegionName": "region", "AreaCode": "area_code", "AveragePrice": "average_price", "Index": "index"},
    {"Date": "date", "Region_Name": "region", "Area_Code": "area_code", "Average_Price": "average_price", "Index": "index"},
]


def clean_price_release(df: DataFrame, region: str | None = None, n_months: int = 60, log: CleanLog | None = None, **stamp) -> DataFrame:
    """CMP-2: price index file in either layout; one region (or all, keyed),
    day-first dates -> month, keep last per (region, month), newest n."""
    return clean_prices(resolve_schema_variant(df, PRICE_VARIANTS), region, n_months, log, **stamp)


def clean_prices(p: DataFrame, region: str | None = None, n_months: int = 60, log: CleanLog | None = None, **stamp) -> DataFrame:
    """CMP-2 for rows that already have the canonical column names."""
    log = log or CleanLog.off()
    p = log.rows(p, "in")
    if region is not None:
        p = p.where(F.col("region") == region)
    p = p.withColumns({"_d": D.parse_dayfirst("date"),
                       "index": F.col("index").cast("string").try_cast("double"),
                       "average_price": F.col("average_price").cast("string").try_cast("double")})
    p = log.rows(p, "parsed", unparsable=F.count_if(F.col("_d").isNull() | F.col("average_price").isNull()), dropped=F.count_if(F.col("_d").isNull()))
    p = p.where(F.col("_d").isNotNull()).withColumn("year_month", D.year_month("_d"))
    ties = [c for c in ("line",) if c in p.columns] + ["average_price", "index"]  # equal dates: file order, then values
    p = log.rows(S.keep_last(p.select("region", "year_month", "_d", *ties), ["region", "year_month"], ["_d", *ties]), "kept")
    p = S.latest_n(p.select("region", "year_month", "index", "average_price"), "year_month", n_months, keys=["region"])
    p = log.rows(p, "out", first=F.min("year_month"), last=F.max("year_month"))
    return R.with_literals(p, **stamp) if stamp else p


# The column names of the public files.
RATE_VARIANTS = [{"Date Changed": "date", "Rate": "rate"}, {"DATE": "date", "IUDBEDR": "rate"}]


def month_end_rate(events: DataFrame, spine: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """CMP-3: rate change events (either layout) -> rate in force at each
    spine month's end (``spine`` holds keys + 'month' as a date). Events
    without a date are dropped; one without a readable rate leaves the
    months it governs missing. Equal dates: file order (``line``) if the
    events have it, then the text of date and rate."""
    e = resolve_schema_variant(events, RATE_VARIANTS)
    line = F.col("line") if "line" in e.columns else F.lit(0)
    e = e.withColumns({"_d": D.parse_dayfirst("date"), "_tie": F.struct(line.alias("l"), F.col("date").alias("d"), F.col("rate").cast("string").alias("r"))})
    e = e.withColumn("rate", F.trim(F.col("rate").cast("string")).try_cast("double")).dropna(subset=["_d"])
    out = asof_fill(spine, e, keys=keys, period="month", visible_period=visible_month(F.col("_d")),
                    event_order=["_d", "_tie"], values=["rate"])
    return out.withColumn("year_month", D.year_month("month"))


def income_by_decile(long: DataFrame, n_periods: int = 5, **stamp) -> DataFrame:
    """CMP-4: (period, decile, value) -> newest periods, fiscal period end
    as 'yyyy-MM', keep last per (period end, decile): by period, then file
    order (``line``) if the rows have it, then value."""
    x = S.latest_n_periods(long, D.fiscal_period_start("period"), n_periods)
    x = x.withColumns({"year_month": D.fiscal_period_end("period"), "_start": D.fiscal_period_start("period"),
                       "_line": F.col("line") if "line" in x.columns else F.lit(0)})
    x = S.keep_last(x.select("year_month", "decile", "value", "_start", "_line"), ["year_month", "decile"], ["_start", "_line", "value"])
    x = x.select("decile", F.col("value").alias("income_value"), "year_month")
    return R.with_literals(x, **stamp) if stamp else x
