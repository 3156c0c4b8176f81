"""Registered queries of readers, sinks, incremental refresh, logs, saved models
and sketches: each writes files that Spark derives from the tables into the shared
checkpoint folder and reads them back through the library's functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from panelkit.functions import dates as D
from panelkit.operators import modelling as ML
from panelkit.operators import quality as Q
from panelkit.operators import relational as R
from panelkit.operators import sketches as SK
from panelkit.operators import stats as A
from panelkit.operators import textscore as TX
from panelkit.plans import queries as P
from panelkit.plans import tables as T
from panelkit.session import drop_path, table_path
from panelkit.sources import releases as RL
from panelkit.sources import sinks as SN
from panelkit.streaming import incremental as INC


# ---------------------------------------------------------------- SRC-12
def refresh_orders(spark: SparkSession, d: str) -> DataFrame:
    """SRC-12: orders land in two deliveries; the second moves every seventh
    order to the next month and corrects its price. A third run finds nothing
    new. Returns the published table."""
    landing, target, checkpoint = (table_path(spark, k) for k in ("landing", "refreshed", "refresh_state"))
    month = F.trunc("o_orderdate", "month")
    o = T.read(spark, d, "orders")
    first = o.select("o_orderkey", D.year_month(month).alias("year_month"), F.col("o_totalprice").alias("price"), F.lit(0).alias("rev"))
    moved = o.where("o_orderkey % 7 = 0").select(
        "o_orderkey", D.year_month(F.add_months(month, 1)).alias("year_month"), (F.col("o_totalprice") + 1).alias("price"), F.lit(1).alias("rev"))
    run = lambda: INC.refresh(spark, landing, first.schema, target, ["o_orderkey"], ["rev"], "year_month", fmt="parquet",
                              checkpoint=checkpoint, versioned=True)
    for part in (first, moved):
        part.write.mode("append").parquet(landing)
        run()
    if run():
        raise RuntimeError("a run without new files must not start a batch")
    return INC.read_current(spark, target).select("o_orderkey", "year_month", "price", "rev")


# --------------------------------------------------------------- SRC-1, 2
PRICE_SCHEMA = StructType([StructField("o_orderkey", LongType()), StructField("day", StringType()), StructField("price", DoubleType())])


def checked_orders(spark: SparkSession, d: str) -> DataFrame:
    """SRC-1: orders as text records, some with an unreadable price or one value
    too many, read against the declared schema: kept and rejected records."""
    path, key = table_path(spark, "export"), F.col("o_orderkey")
    price = F.when(key % 50 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    extra = F.when(key % 77 == 0, F.lit("more"))
    T.read(spark, d, "orders").select(F.concat_ws(",", key.cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd"), price, extra)).write.text(path)
    kept, rejected = RL.read_checked(spark, path, PRICE_SCHEMA, header=False)
    bad = rejected.select(F.split("record", ",")[0].cast("long").alias("o_orderkey"), F.lit(None).cast("double").alias("price"), F.lit("rejected").alias("status"))
    return kept.select("o_orderkey", "price", F.lit("kept").alias("status")).unionByName(bad)


def _single_csv(spark: SparkSession, lines: DataFrame, folder: str, name: str) -> None:
    """A release of period grain as one file of the given name."""
    draft = f"{folder}/{name}.draft"
    lines.coalesce(1).sortWithinPartitions("line").select("_c0", "_c1").write.csv(draft)
    fs, p = INC._fs(spark, draft)
    part = next(f.getPath() for f in fs.listStatus(p) if f.getPath().getName().startswith("part-"))
    fs.rename(part, INC._fs(spark, f"{folder}/{name}")[1])
    drop_path(spark, draft)


def release_files(spark: SparkSession, d: str) -> DataFrame:
    """SRC-2: two dated releases in a folder, headerless and with a preamble;
    the newer file's values win. Cleaned as CMP-1."""
    folder, lines = table_path(spark, "releases"), T.period_table(P._release_lines(spark, d))
    old = lines.withColumn("_c1", F.when(F.col("line") >= 300000, F.lit("-1.5")).otherwise(F.col("_c1")))
    _single_csv(spark, lines, folder, "aov_20020101.csv")
    _single_csv(spark, old, folder, "aov_20010101.csv")
    series = RL.select_series(RL.read_release(spark, folder), "average order")
    return RL.clean_monthly_release(series, n_months=60, geo_name="ALL", source_note="orders release")


# --------------------------------------------------------------- SRC-4, 5
def _daily_prices(spark: SparkSession, d: str) -> DataFrame:
    o = T.orders_with_nation(spark, d)
    n = T.read(spark, d, "nation").select(F.col("n_nationkey").alias("nation_key"), "n_name")
    return (o.groupBy("nation_key", F.to_date("o_orderdate").alias("day"))
             .agg((T.money_sum("o_totalprice") / F.count(F.lit(1))).alias("price")).join(n, "nation_key"))


def mixed_layouts(spark: SparkSession, d: str) -> DataFrame:
    """SRC-4 and SRC-5: price files in two layouts and one alien file in a
    folder, each file's layout told by its header, cleaned as CMP-2."""
    folder, daily = table_path(spark, "layouts"), T.period_table(_daily_prices(spark, d))
    day, index = F.date_format("day", "dd/MM/yyyy"), F.col("price") / 1000
    area = F.concat(F.lit("N"), F.col("nation_key").cast("string"))
    even = daily.where("nation_key % 2 = 0").select(day.alias("Date"), F.col("n_name").alias("RegionName"), area.alias("AreaCode"),
                                                    F.col("price").alias("AveragePrice"), index.alias("Index"))
    odd = daily.where("nation_key % 2 = 1").select(index.alias("Index"), F.col("price").alias("Average_Price"), F.lit("x").alias("Note"),
                                                   F.col("n_name").alias("Region_Name"), day.alias("Date"), area.alias("Area_Code"))
    alien = daily.limit(20).coalesce(1).select(day.alias("When"), F.col("n_name").alias("Where"))
    for name, part in (("even", even), ("odd", odd), ("alien", alien)):
        part.write.option("header", True).csv(f"{folder}/{name}")
    rows, rejected = RL.read_variants(spark, folder, RL.PRICE_VARIANTS)
    out = RL.clean_prices(rows, n_months=60).select("region", "year_month", "index", "average_price")
    return out.withColumn("rejected_files", rejected.select(F.count(F.lit(1))).scalar())


# ------------------------------------------------------------ QC-11, AGG-21
def observed_log(spark: SparkSession, d: str) -> DataFrame:
    """QC-11 with AGG-21: the log of two cleanings, counted while they ran."""
    orders, prices = Q.CleanLog("orders"), Q.CleanLog("prices")
    series = RL.select_series(P._release_lines(spark, d), "average order")
    T.period_table(RL.clean_monthly_release(series, n_months=60, log=orders))
    daily = _daily_prices(spark, d)
    day = F.when(F.dayofmonth("day") == 13, F.lit("no date")).otherwise(F.date_format("day", "dd/MM/yyyy"))
    raw = daily.select(day.alias("Date"), F.col("n_name").alias("RegionName"), F.lit("").alias("AreaCode"), F.col("price").alias("AveragePrice"), F.col("price").alias("Index"))
    T.period_table(RL.clean_price_release(raw, n_months=60, log=prices))
    return Q.observed_log(spark, [orders, prices])


# ------------------------------------------------------------------- TXT-3
def _load_scorer():
    def score(texts):
        return (texts.str.count("a") - texts.str.count("e")) / (texts.str.len() + 1)
    return score


def scored_texts(spark: SparkSession, d: str) -> DataFrame:
    """TXT-3: a scorer loaded in the workers, labelled by thresholds."""
    docs = T.read(spark, d, "documents").select("doc_id", "text")
    s = TX.label_by_threshold(TX.score_with(docs, "text", load=_load_scorer), "compound", 0.0, -0.05)
    return s.select("doc_id", F.round("compound", 6).alias("compound"), "label")


# --------------------------------------------------------- ML-2, 3, 5; SNK-3
FOREST_DEPTH = 5


def forest_nodes(spark: SparkSession, d: str) -> DataFrame:
    """ML-2, ML-3, ML-5 and SNK-3: a forest is saved, its trees read as a
    table of nodes; scoring by the table, by the model and by the loaded model
    agree row by row, importances follow from the gains, and a model with other
    features is refused."""
    f = P._model_frame(spark, d)
    model = ML.fit_forest(f.where(F.col("split") == "train"), P.LAG_FEATURES, "value_m", max_depth=FOREST_DEPTH)
    path = table_path(spark, "models")
    ML.save_model(model, path)
    nodes = T.period_table(ML.forest_nodes(spark, path))
    own = ML.predict(model, ML.score_nodes(nodes, f, P.LAG_FEATURES, FOREST_DEPTH, "by_nodes"))
    again = ML.predict(ML.load_model(path, P.LAG_FEATURES), f.select("year_month", *P.LAG_FEATURES)).withColumnRenamed("prediction", "loaded")
    rows = T.period_table(own.join(again.select("year_month", "loaded"), "year_month"))
    same = lambda c: F.count_if(F.abs(F.col(c) - F.col("prediction")) < 1e-9)
    one = lambda df, name, n, equal: df.agg(F.lit(name).alias("what"), n.alias("n"), equal.alias("n_equal"))
    imp = ML.importances(spark, model, P.LAG_FEATURES).join(ML.node_importances(nodes, P.LAG_FEATURES).withColumnRenamed("importance", "by_gain"), "feature", "left")
    try:
        ML.load_model(path, P.LAG_FEATURES[::-1])
        refused = 0
    except ValueError:
        refused = 1
    many = F.count(F.lit(1))
    return R.union_all([
        one(rows, "nodes", many, same("by_nodes")), one(rows, "loaded", many, same("loaded")),
        one(imp, "importances", many, F.count_if(F.abs(F.col("importance") - F.coalesce("by_gain", F.lit(0.0))) < 1e-9)),
        spark.range(1).select(F.lit("refused").alias("what"), F.col("id") + 1, F.lit(refused).cast("long")).toDF("what", "n", "n_equal"),
        one(nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "trees", many, F.count_if(F.col("n") < 2 ** (FOREST_DEPTH + 1))),
    ])


# ------------------------------------------------------------ AGG-6, AGG-17
QS = [0.25, 0.5, 0.75, 0.99]


def quantile_sketches(spark: SparkSession, d: str) -> DataFrame:
    """AGG-6 beyond memory: a sketch per (priority, month), merged over the
    months; its quantiles, and whether they are within 1 % of an exact value of
    the same rank."""
    o = T.read(spark, d, "orders").select("o_orderpriority", T.month_key("o_orderdate").alias("month"), "o_totalprice")
    stored = T.period_table(SK.quantile_sketch(o, "o_totalprice", ["o_orderpriority", "month"]))
    est = SK.sketch_quantiles(SK.merge_sketches(stored, ["o_orderpriority"]), QS, ["o_orderpriority"])
    exact = A.exact_quantiles(o, "o_totalprice", QS, groups=["o_orderpriority"])
    exact = exact.select("o_orderpriority", F.explode(F.array(*[F.struct(F.lit(q).alias("q"), F.col(f"q{i}").alias("x")) for i, q in enumerate(QS)])).alias("e")).select("o_orderpriority", "e.*")
    close = F.abs(F.col("estimate") / F.col("x") - 1) <= 0.02  # 1 % and the step between two neighbouring values
    return est.join(exact, ["o_orderpriority", "q"]).select("o_orderpriority", "q", "n", F.round("estimate", 4).alias("estimate"), close.alias("close"))


def distinct_sketches(spark: SparkSession, d: str) -> DataFrame:
    """AGG-17 approximate: distinct customers per priority from sketches per
    month, beside the exact number, within four standard errors."""
    o = T.read(spark, d, "orders").select("o_orderpriority", T.month_key("o_orderdate").alias("month"), "o_custkey")
    stored = T.period_table(SK.distinct_sketch(o, "o_custkey", ["o_orderpriority", "month"]))
    est = SK.distinct_estimate(SK.merge_distinct(stored, ["o_orderpriority"]))
    exact = o.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("customers"))
    close = F.abs(F.col("estimate") / F.col("customers") - 1) <= 4 * 1.04 / 2 ** 6
    return exact.join(est, "o_orderpriority").select("o_orderpriority", "customers", close.alias("close"))


# ------------------------------------------------------------- SNK-1, SNK-2
def sink_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """SNK-1 and SNK-2: orders written in key order per status and read back by
    a range of keys; nations as one JSON array and read back."""
    table, array = table_path(spark, "sorted_orders"), table_path(spark, "nations_json")
    SN.write_table(T.read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), table, partition_by=["o_orderstatus"], sort_by=["o_orderstatus", "o_orderkey"])
    SN.write_records_json(T.read(spark, d, "nation").select("n_nationkey", "n_name"), array, as_single_array=True)
    back = spark.read.parquet(table).where((F.col("o_orderstatus") == "F") & F.col("o_orderkey").between(1000, 20000))
    nations = spark.read.schema("n_nationkey long, n_name string").json(array, multiLine=True)
    return back.select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("string").cast("double").alias("value"), F.lit(None).cast("string").alias("name")).unionByName(
        nations.select(F.lit("nations").alias("source"), F.col("n_nationkey").alias("id"), F.lit(None).cast("double").alias("value"), F.col("n_name").alias("name")))


NAMES = ["refresh_orders", "checked_orders", "release_files", "mixed_layouts", "observed_log", "scored_texts", "forest_nodes",
         "quantile_sketches", "distinct_sketches", "sink_round_trip"]
