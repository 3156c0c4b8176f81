"""Spark side of every registered query: (spark, sf_dir) -> DataFrame.

Dates leave as ISO text and money as double so results compare exactly
with the SQL oracle; every computed column carries an explicit alias.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.functions import dates as D
from panelkit.functions import text as TF
from panelkit.functions.text import case_label, pct_change
from panelkit.operators import modelling as ML
from panelkit.operators import ordering as O
from panelkit.operators import quality as Q
from panelkit.operators import relational as R
from panelkit.operators import scenario as SC
from panelkit.operators import series as S
from panelkit.operators import stats as A
from panelkit.operators import textscore as TX
from panelkit.operators.asof import asof_fill, visible_month
from panelkit.plans import analyses as C
from panelkit.plans import tables as T
from panelkit.sources import releases as RL
from panelkit.sources import web as WB

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
LM_MEASURES = ["n_lines", "qty", "ship_value", "avg_discount", "avg_tax"]


def _iso(c):
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


# ----------------------------------------------------------------- merging
def macro_merge(spark: SparkSession, d: str) -> DataFrame:
    """CMP-5: monthly lineitem panel left-joined with monthly orders."""
    panel, _ = C.monthly_macro(T.lm(spark, d), left=[T.om(spark, d)],
                               stamp={"geo_name": "ALL", "source_note": "orders+lineitem"})
    return panel


def structural_missing(spark: SparkSession, d: str) -> DataFrame:
    """JN-4 + QC-6: order columns are structurally missing in months the
    orders table never published."""
    o = T.om(spark, d)
    panel = R.mark_absent(R.left_join(T.lm(spark, d), o, "year_month"), o, ["year_month"], flag="absent")
    rule = F.col("absent")
    cols = LM_MEASURES + ["n_orders", "order_value"]
    return Q.missingness(panel, cols, structural={"n_orders": rule, "order_value": rule})


# ------------------------------------------------------------------- as-of
def asof_day_end(spark: SparkSession, d: str) -> DataFrame:
    """JN-3: per event type, the event in force at the end of each day
    (events strictly before the next midnight; ties broken by event_id)."""
    ev = T.read(spark, d, "events")
    # the last event of each (type, day), once: bounds, keys and values come from it
    daily = T.period_table(S.keep_last(ev.select("event_type", F.to_date("ts").alias("day"), "ts", "event_id", "value"),
                                       ["event_type", "day"], ["ts", "event_id"]))
    b = daily.select(F.struct(F.min("day").alias("lo"), F.max("day").alias("hi"))).scalar()
    spine = (daily.select("event_type").distinct()
                  .select("event_type", F.explode(F.sequence(b["lo"], b["hi"])).alias("day")))
    out = asof_fill(spine, daily, keys=["event_type"], period="day", visible_period=F.col("day"),
                    event_order=["ts", "event_id"], values=["value", "event_id"])
    return out.select("event_type", _iso("day").alias("day"), "value", "event_id")


def asof_month_end_status(spark: SparkSession, d: str) -> DataFrame:
    """JN-3: last order price per nation in force at each month end."""
    o = T.orders_with_nation(spark, d).withColumns({"month": visible_month("o_orderdate"), "own": T.month_key("o_orderdate")})
    # the last order visible in each (nation, month), once
    o = T.period_table(o.groupBy("nation_key", "month").agg(
        F.max_by(F.struct("o_orderdate", "o_orderkey", "o_totalprice"), F.struct("o_orderdate", "o_orderkey")).alias("_r"),
        F.min("own").alias("lo"), F.max("own").alias("hi")).select("nation_key", "month", "lo", "hi", "_r.*"))
    b = o.select(F.struct(F.min("lo").alias("lo"), F.max("hi").alias("hi"))).scalar()
    spine = (T.read(spark, d, "nation").select(F.col("n_nationkey").alias("nation_key"))
             .select("nation_key", F.explode(F.sequence(b["lo"], b["hi"], F.expr("INTERVAL 1 MONTH"))).alias("month")))
    out = asof_fill(spine, o, keys=["nation_key"], period="month", visible_period=F.col("month"),
                    event_order=["o_orderdate", "o_orderkey"], values=["o_totalprice", "o_orderkey"])
    return out.select("nation_key", D.year_month("month").alias("year_month"), "o_totalprice", "o_orderkey")


# ------------------------------------------------------------ de-duplication
def keep_last(spark: SparkSession, d: str) -> DataFrame:
    """WIN-6: newest order per customer (order date, then order key)."""
    o = T.read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    out = S.keep_last(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return out.withColumn("o_orderdate", _iso("o_orderdate"))


def keep_first(spark: SparkSession, d: str) -> DataFrame:
    """WIN-7: one document per exact text, the lowest doc_id. Grouping is on
    a 256-bit digest plus length, so the shuffle carries 40 bytes per row
    instead of the whole text."""
    docs = T.read(spark, d, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        F.sha2("text", 256).alias("_h"), F.length("text").alias("_len"))
    out = S.keep_first(docs, ["_h", "_len"], ["doc_id"])
    return out.select("doc_id", "lang", "source", "n_chars")


def dup_report(spark: SparkSession, d: str) -> DataFrame:
    """QC-4: per language, documents, distinct texts and duplicates."""
    docs = T.read(spark, d, "documents").select("lang", F.sha2("text", 256).alias("_h"), F.length("text").alias("_len"))
    per_text = docs.groupBy("lang", "_h", "_len").agg(F.count(F.lit(1)).alias("_n"))
    return per_text.groupBy("lang").agg(F.sum("_n").cast("long").alias("n_docs"),
                                         F.count(F.lit(1)).alias("distinct_texts"),
                                         F.sum(F.col("_n") - 1).cast("long").alias("duplicates"))


# ---------------------------------------------------------------- windows
def latest_n(spark: SparkSession, d: str) -> DataFrame:
    """WIN-8: newest 12 months per nation."""
    return S.latest_n(T.np_panel(spark, d), "year_month", 12, keys=["nation_key"])


def latest_periods(spark: SparkSession, d: str) -> DataFrame:
    """WIN-9: every order of the newest five order years."""
    o = T.read(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("o_year"), "o_totalprice")
    return S.latest_n_periods(o, "o_year", 5)


def lag_features(spark: SparkSession, d: str) -> DataFrame:
    """WIN-1 + FLT-6: lags 1 and 3 of the monthly order series. The input
    has one row per month (calendar-bounded), so a plain lag window is the
    cheap plan; ``distributed=True`` is the choice for long unkeyed tables."""
    return S.lag_features(T.om(spark, d), {"n_orders": [1, 3], "order_value": [1]}, "year_month")


def running_max_drop(spark: SparkSession, d: str) -> DataFrame:
    """WIN-2 + WIN-11 + AGG-10 per nation: first month above the floor,
    first month below the running maximum, and the peak month."""
    p = S.running_max(T.np_panel(spark, d), "order_value", "year_month", keys=["nation_key"])
    out = p.groupBy("nation_key").agg(
        S.first_event_agg(F.col("n_orders") >= 10, "year_month").alias("first_rise"),
        S.first_event_agg(F.col("order_value") < F.col("order_value_running_max"), "year_month").alias("first_drop"),
        A.argmax_agg("order_value", ["year_month"], ["year_month", "order_value"]).alias("_peak"))
    return out.select("nation_key", "first_rise", "first_drop", F.col("_peak.year_month").alias("peak_year_month"),
                      F.col("_peak.order_value").alias("peak_order_value"))


def index100(spark: SparkSession, d: str) -> DataFrame:
    """WIN-3: order value indexed to each nation's first month."""
    out = S.index100(T.np_panel(spark, d), ["order_value"], "year_month", keys=["nation_key"], digits=4)
    return out.select("nation_key", "year_month", "order_value", "order_value_index")


BASE_YEAR = 1996


def base_period_index(spark: SparkSession, d: str) -> DataFrame:
    """WIN-3 + JN-5: decile income indexed to a named base year."""
    out = S.index100(T.dec(spark, d), ["income"], "year", keys=["decile"], base_time=BASE_YEAR, digits=4)
    return out.select("decile", "year", "income", "income_index")


PRICE_BASE_YEAR = 1995


def price_level(spark: SparkSession, d: str) -> DataFrame:
    """WIN-4: cumulative price level from the yearly mean tax rate."""
    out = S.price_level(T.yearly_tax_rate(spark, d), "rate", "year", PRICE_BASE_YEAR)
    return out.select("year", "rate", "price_level")


def gap_check(spark: SparkSession, d: str) -> DataFrame:
    """WIN-5: per user, active days that do not follow the previous active day."""
    days = T.read(spark, d, "events").select("user_id", F.to_date("ts").alias("day")).distinct()
    out = S.gap_check(days, "day", keys=["user_id"], ordinal=D.day_ordinal)
    return out.select("user_id", _iso("day").alias("day"), _iso("prev_day").alias("prev_day"), F.col("gap").cast("int").alias("gap"))


def chrono_split(spark: SparkSession, d: str) -> DataFrame:
    """WIN-10: per nation, first 80 % of months train, rest test; counts."""
    s = S.chronological_split(T.np_panel(spark, d), "year_month", 0.8, keys=["nation_key"])
    return s.groupBy("nation_key", "split").agg(F.count(F.lit(1)).alias("n_rows"))


def latest_row(spark: SparkSession, d: str) -> DataFrame:
    """WIN-12 + AGG-10: newest event and largest-value event per type."""
    ev = T.read(spark, d, "events").select("event_type", "event_id", "ts", "value")
    out = ev.groupBy("event_type").agg(
        F.max_by(F.struct("event_id", "ts", "value"), F.struct("ts", "event_id")).alias("_new"),
        A.argmax_agg("value", ["ts", "event_id"], ["event_id", "value"]).alias("_top"))
    return out.select("event_type", F.col("_new.event_id").alias("latest_event_id"),
                      F.date_format("_new.ts", TS_FMT).alias("latest_ts"), F.col("_new.value").alias("latest_value"),
                      F.col("_top.event_id").alias("max_event_id"), F.col("_top.value").alias("max_value"))


# ------------------------------------------------------------------ stats
PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def profile(spark: SparkSession, d: str) -> DataFrame:
    """AGG-5 + SET-7: per measure count/mean/std/min/median/max."""
    return A.profile(T.read(spark, d, "lineitem").select(*PROFILE_COLS), PROFILE_COLS, digits=4, exact_digits=2)


def describe(spark: SparkSession, d: str) -> DataFrame:
    """AGG-6: extended price quartiles per return flag."""
    li = T.read(spark, d, "lineitem").select("l_returnflag", "l_extendedprice")
    out = A.describe(li, "l_extendedprice", keys=["l_returnflag"], exact_digits=2)
    return out.select("l_returnflag", "count", "mean", *[F.round(c, 4).alias(c) for c in ("std", "min", "p25", "p50", "p75", "max")])


def value_counts(spark: SparkSession, d: str) -> DataFrame:
    """AGG-7: order priorities, preferred labels first."""
    return A.value_counts(T.read(spark, d, "orders"), "o_orderpriority", preferred=["1-URGENT", "2-HIGH"])


def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    """AGG-3 + AGG-4: per (day, event type) mean value and label counts."""
    ev = T.read(spark, d, "events").withColumns({
        "_d": F.to_date("ts"),
        "band": case_label("value", 100.0, 10.0, "high", "low", "mid")})
    out = A.label_counts(ev, ["_d", "event_type"], "band", ["high", "mid", "low"],
                         extra=[T.exact_mean("value", 2).alias("mean_value")])
    return out.withColumn("day", _iso("_d")).drop("_d")  # formatted once per group


def coverage(spark: SparkSession, d: str) -> DataFrame:
    """AGG-9 + AGG-17: month coverage per order status."""
    o = T.read(spark, d, "orders").withColumn("_m", T.month_key("o_orderdate"))
    out = A.coverage(o, F.col("_m"), keys=["o_orderstatus"])
    # months were compared as dates; the text form is rebuilt on the few result rows
    lo_hi = F.split("coverage", " to ")
    return out.withColumn("coverage", F.when(F.col("coverage") == "no rows", F.col("coverage")).otherwise(
        F.concat_ws(" to ", F.substring(lo_hi[0], 1, 7), F.substring(lo_hi[1], 1, 7))))


def pearson(spark: SparkSession, d: str) -> DataFrame:
    """AGG-11: all pairs of the monthly lineitem measures."""
    return A.pearson_matrix(T.lm(spark, d), LM_MEASURES, digits=6)


def spearman(spark: SparkSession, d: str) -> DataFrame:
    """AGG-12 on the monthly grain: the frame has one row per month
    (calendar-bounded), so plain rank windows are the cheap choice."""
    return A.spearman_matrix(T.lm(spark, d), LM_MEASURES, digits=6, method="window")


CORR_GAP_TOL = 0.05


def corr_gap(spark: SparkSession, d: str) -> DataFrame:
    """AGG-13: pairs whose Pearson and Spearman disagree by more than tol."""
    return A.rank_linear_gap(T.lm(spark, d), LM_MEASURES, tol=CORR_GAP_TOL, digits=6, method="window")


def lagged_corr(spark: SparkSession, d: str) -> DataFrame:
    """AGG-14: monthly order count lagged 1 and 3 vs each lineitem measure,
    on the months both tables publish (JN-1)."""
    both = R.inner_join(T.om(spark, d).select("year_month", "n_orders"), T.lm(spark, d), "year_month")
    lagged = S.lag_features(both, {"n_orders": [1, 3]}, "year_month", drop_incomplete=False)  # month grain
    parts = []
    for n in (1, 3):
        x = f"n_orders_lag{n}"
        m = A.pearson_matrix(lagged.select(x, *LM_MEASURES), [x, *LM_MEASURES], digits=6)
        parts.append(m.where(F.col("a") == x).select(F.lit(n).alias("lag"), F.col("b").alias("y"), "r"))
    return R.union_all(parts)


def histogram(spark: SparkSession, d: str) -> DataFrame:
    """AGG-15: twelve equal-width bins of order totals."""
    h = A.histogram(T.read(spark, d, "orders"), "o_totalprice", bins=12)
    return h.select("bin", "count", F.round("bin_lo", 4).alias("bin_lo"), F.round("bin_hi", 4).alias("bin_hi"))


def sigma_outliers(spark: SparkSession, d: str) -> DataFrame:
    """AGG-16: per event type, 3-sigma bounds and rows outside."""
    out = A.sigma_outliers(T.read(spark, d, "events"), ["value"], k=3.0, keys=["event_type"])
    return out.select("event_type", "column", F.round("lower", 4).alias("lower"),
                      F.round("upper", 4).alias("upper"), "outliers")


def _naive_predictions(spark: SparkSession, d: str) -> DataFrame:
    o = S.lag_features(T.om(spark, d), {"order_value": [1, 2, 3]}, "year_month")  # month grain
    return o.select("year_month", F.col("order_value").alias("y_true"),
                    F.col("order_value_lag1").alias("naive_last"),
                    ((F.col("order_value_lag1") + F.col("order_value_lag2") + F.col("order_value_lag3")) / 3)
                    .alias("naive_mean3"))


def reg_metrics(spark: SparkSession, d: str) -> DataFrame:
    """AGG-18 + ML-8 + JN-8: two naive monthly predictors, improvements of
    each over the 'naive_last' baseline."""
    long = R.unpivot_columns(_naive_predictions(spark, d), ["year_month", "y_true"],
                             ["naive_last", "naive_mean3"], "model", "y_pred")
    m = A.regression_metrics(long, "y_true", "y_pred", keys=["model"])
    return R.versus_baseline(m, "model", "naive_last")


def pivot_year(spark: SparkSession, d: str) -> DataFrame:
    """AGG-20: decile x year income table, its cells as rows (missing ones too)."""
    dec = T.period_table(T.dec(spark, d))  # read twice: uniqueness check, then pivot
    years = sorted(r["year"] for r in dec.select("year").distinct().collect())  # calendar-bounded
    wide = A.pivot_wide(dec, ["decile"], "year", "income", years, name=lambda y: f"y{y}")
    return R.unpivot_columns(wide, ["decile"], [f"y{y}" for y in years], "column", "income")


def unpivot_predictions(spark: SparkSession, d: str) -> DataFrame:
    """SET-5 + ML-9 + DT-7: residual table of the two naive predictors."""
    hold = _naive_predictions(spark, d).withColumn("month", F.to_date("year_month", "yyyy-MM"))
    out = ML.residuals(hold, "month", "y_true", ["naive_last", "naive_mean3", "not_a_model"], keep=["year_month"])
    return out.select("year_month", "model", "y_true", *[F.round(c, 4).alias(c) for c in ("y_pred", "residual", "absolute_error")], "quarter")


def intersect_periods(spark: SparkSession, d: str) -> DataFrame:
    """JN-6 + SET-2: months both series publish, both sides restricted."""
    a, b = R.shared_periods(T.om(spark, d), T.lm(spark, d), ["year_month"])
    return a.select("year_month", "n_orders").join(b.select("year_month", "n_lines"), "year_month")


# --------------------------------------------------------------- filters
SEARCH_PATTERN = r"ring|brand#1[0-2]$|economy"


def any_column_search(spark: SparkSession, d: str) -> DataFrame:
    """FLT-8: parts where any column, as text, matches the pattern."""
    return R.search_any_column(T.read(spark, d, "part"), SEARCH_PATTERN)


def typed_filters(spark: SparkSession, d: str) -> DataFrame:
    """FLT-1..5 + FLT-9 over orders joined with customers."""
    o = T.read(spark, d, "orders")
    c = T.read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    j = o.join(c, "o_custkey").where(
        (F.col("o_orderstatus") == "F")
        & R.ieq("c_mktsegment", "Building")
        & F.col("o_totalprice").between(50000, 300000)
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"))
    return j.select("o_orderkey", "o_custkey", "o_totalprice",
                    (~F.col("o_totalprice").between(60000, 250000)).alias("implausible"))


def date_parse(spark: SparkSession, d: str) -> DataFrame:
    """DT-1..4, DT-11, PRJ-3: format order dates to release-style text and
    parse them back."""
    o = T.read(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    od = F.col("o_orderdate")
    t = o.withColumns({
        "month_label": F.upper(F.date_format(od, "yyyy MMM")),
        "dayfirst_text": F.date_format(od, "dd/MM/yyyy"),
        "two_digit_text": F.upper(F.date_format(od, "dd MMM yy")),
        "file_name": F.concat(F.lit("orders_"), F.date_format(od, "yyyyMMdd"), F.lit(".csv")),
        "price_text": F.concat(F.lit(" "), F.col("o_totalprice").cast("string"), F.lit(" ")),
    })
    return t.select(
        "o_orderkey", "month_label",
        _iso(D.parse_month_label("month_label")).alias("month_start"),
        _iso(D.parse_dayfirst("dayfirst_text")).alias("dayfirst_date"),
        _iso(D.parse_dayfirst("two_digit_text")).alias("two_digit_date"),
        D.year_month(D.parse_year_month(D.year_month(od))).alias("year_month"),
        _iso(D.stamp_to_date("file_name", strict=True)).alias("stamp_date"),
        F.trim("price_text").try_cast("double").alias("price"))


def fiscal_period(spark: SparkSession, d: str) -> DataFrame:
    """DT-9 + DT-10: fiscal labels in four layouts built from order years."""
    o = T.read(spark, d, "orders")
    y = o.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n_orders"))
    nxt = F.col("year") + 1
    labels = y.withColumns({
        "short_dash": F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad((nxt % 100).cast("string"), 2, "0")),
        "short_slash": F.concat(F.col("year").cast("string"), F.lit("/"), F.lpad((nxt % 100).cast("string"), 2, "0")),
        "long_dash": F.concat(F.col("year").cast("string"), F.lit("-"), nxt.cast("string")),
        "single": F.col("year").cast("string"),
    })
    long = labels.unpivot(["year", "n_orders"], ["short_dash", "short_slash", "long_dash", "single"], "layout", "label")
    return long.select("year", "n_orders", "layout", "label",
                       D.fiscal_period_end("label").alias("period_end"),
                       D.fiscal_period_start("label").alias("period_start"))


# ------------------------------------------------------------- composites

CHANGE_START, CHANGE_END = 1995, 2000


def real_income(spark: SparkSession, d: str) -> DataFrame:
    """CMP-6: decile income deflated by the tax-rate price level, 1995 = 100."""
    return C.real_income_index(T.period_table(T.dec(spark, d)), T.period_table(T.yearly_tax_rate(spark, d)),
                               PRICE_BASE_YEAR)


def real_change(spark: SparkSession, d: str) -> DataFrame:
    """CMP-7: real income change 1995 -> 2000 per decile."""
    return C.real_change(T.period_table(T.dec(spark, d)), T.period_table(T.yearly_tax_rate(spark, d)),
                         PRICE_BASE_YEAR, CHANGE_START, CHANGE_END)


def _part_price(spark: SparkSession, d: str) -> DataFrame:
    li = T.read(spark, d, "lineitem").select("l_partkey", F.year("l_shipdate").alias("year"))
    p = T.read(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return li.join(p, "l_partkey").groupBy("year").agg(T.exact_mean("p_retailprice", 2).alias("price"))


def pressure_gap(spark: SparkSession, d: str) -> DataFrame:
    """CMP-8..10: shipped-part price index vs decile income index."""
    return C.pressure_gap(T.period_table(_part_price(spark, d)), T.period_table(T.dec(spark, d)))


def turning_points(spark: SparkSession, d: str) -> DataFrame:
    """CMP-11 on the monthly order value (one row per month, so the
    running-maximum window covers a calendar-bounded frame)."""
    o = T.om(spark, d)
    start = o.select(F.min_by("n_orders", "year_month")).scalar()  # the first month's count as floor
    out = C.turning_points(o, "year_month", rise_col="n_orders", floor=start, peak_col="order_value",
                           cut_col="order_value")
    return out.withColumnRenamed("peak_time", "peak_month")


BURDEN_YEAR = 2000
LTV, SHOCK_PP = 0.75, 1.0


def burden(spark: SparkSession, d: str) -> DataFrame:
    """BRD-1 + BRD-2 + AGG-22: extra annual cost of a one-point rise on the
    latest month's average order, as a share of each decile's income."""
    o = T.om(spark, d).withColumn("avg_price", F.col("order_value") / F.col("n_orders"))
    bench = SC.mortgage_benchmark(o, "avg_price", "year_month", ltv=LTV, shock_pp=SHOCK_PP)
    inc = T.period_table(T.dec(spark, d)).where(F.col("year") == BURDEN_YEAR)
    cost = bench.select("extra_annual_cost").scalar()
    shares = SC.burden_by_group(inc.withColumn("extra_annual_cost", cost), F.col("extra_annual_cost"))
    ratio = A.extremes_ratio(shares, "decile", "burden_share", 1, 10)
    return shares.withColumn("ratio", ratio.select("ratio").scalar()).select(
        "decile", "income", "extra_annual_cost", "burden_share",
        F.round("ratio", 4).alias("extremes_ratio"))


# ------------------------------------------------------------------- text
# Fixed parameter table: a small own lexicon of syllables that occur in the
# synthetic corpus (weights in quarters keep the sums exact).
LEXICON = [
    ("tion", 1.0, "worsening"), ("ble", 0.5, "worsening"), ("sch", 1.5, "worsening"),
    ("ung", 1.0, "worsening"), ("que", 0.75, "worsening"), ("ción", 1.25, "worsening"),
    ("thr", 0.5, "worsening"), ("crisis", 2.0, "worsening"), ("higher", 1.0, "worsening"),
    ("pressure", 1.5, "worsening"),
    ("eau", 1.0, "relief"), ("ment", 0.5, "relief"), ("ier", 0.75, "relief"), ("ist", 1.0, "relief"),
    ("ein", 0.5, "relief"), ("ado", 1.25, "relief"), ("aux", 0.5, "relief"), ("ease", 1.5, "relief"),
    ("relief", 2.0, "relief"), ("lower", 1.0, "relief"),
]
SCORE_COLS = ["worsening", "relief", "score", "net"]


def lexicon_score(spark: SparkSession, d: str) -> DataFrame:
    """TXT-1 + TXT-2 + STR-2: per document lexicon score and label."""
    docs = T.read(spark, d, "documents").select("doc_id", "text")
    s = TX.lexicon_score(docs, "text", LEXICON)
    return s.select("doc_id", "worsening_hits", "relief_hits", "W", "R",
                    *[F.round(c, 6).alias(c) for c in SCORE_COLS], "label")


def text_panel(spark: SparkSession, d: str) -> DataFrame:
    """TXT-4 + TXT-5: cleaned, de-duplicated corpus scored and aggregated by
    (month, source); the month is derived from doc_id."""
    docs = T.read(spark, d, "documents").select("doc_id", "text", "source")
    # scoring is a per-row projection, so score first and de-duplicate the
    # small scored rows: whole texts never enter the shuffle
    scored = TX.clean_corpus(TX.lexicon_score(docs, "text", LEXICON), "text", ["doc_id"], keep_text=False)
    month = D.year_month(F.make_date(F.lit(2024), (F.col("doc_id") % 12 + 1).cast("int"), F.lit(1)))
    return TX.monthly_text_panel(scored, month, ["source"])


def phrase_audit(spark: SparkSession, d: str) -> DataFrame:
    """FLT-11: documents containing whole benchmark passages."""
    return WB.phrase_audit(T.read(spark, d, "documents"), T.read(spark, d, "benchmark"))


def phrase_hits(spark: SparkSession, d: str) -> DataFrame:
    """FLT-11 per-phrase counts: documents containing each benchmark passage."""
    return WB.phrase_audit(T.read(spark, d, "documents"), T.read(spark, d, "benchmark"), by="phrase")


def payload_kind(spark: SparkSession, d: str) -> DataFrame:
    """SRC-10 over page HTML and document texts."""
    pages = T.read(spark, d, "pages").select(F.lit("pages").alias("source"), F.col("page_id").alias("id"),
                                             F.col("html").alias("payload"))
    docs = T.read(spark, d, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"),
                                                F.col("text").alias("payload"))
    return WB.payload_kind(pages.unionByName(docs), "payload").select("source", "id", "kind")


LINK_PATTERN = r'href="([^"]+)"'
LINK_FALLBACK = r'src="([^"]+)"'


def extract_links(spark: SparkSession, d: str) -> DataFrame:
    """SRC-11: distinct links per page in first-seen order."""
    return WB.extract_links(T.read(spark, d, "pages"), "html", LINK_PATTERN, LINK_FALLBACK)


def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """SRC-9: newest page per host by (path number, https, www host, url)."""
    p = T.read(spark, d, "pages").select("page_id", "url")
    host = WB.host_of("url")
    stamp = F.coalesce(F.regexp_extract("url", r"/(\d+)(?:[?#]|$)", 1).try_cast("long"), F.lit(0))
    ext = F.when(F.startswith(F.lower("url"), F.lit("https:")), 2).otherwise(1)
    canonical = F.when(F.startswith(host, F.lit("www.")), 1).otherwise(0)
    return WB.latest_snapshot(p, "url", host, stamp, ext, canonical, ["page_id", "url"]) \
             .withColumnRenamed("dataset", "host")


# ------------------------------------------------------------- modelling

MILLION = 1_000_000.0
LAG_FEATURES = ["n_orders_lag1", "n_orders_lag3", "value_m_lag1"]


def _model_frame(spark: SparkSession, d: str) -> DataFrame:
    o = T.om(spark, d).withColumn("value_m", F.col("order_value") / MILLION)
    lagged = S.lag_features(o, {"n_orders": [1, 3], "value_m": [1]}, "year_month")  # month grain
    f = S.chronological_split(lagged, "year_month", 0.8).withColumn("n_orders", F.col("n_orders").cast("double"))
    # estimators make several passes over their input: materialise the
    # month-grain frame once instead of re-aggregating the orders each pass
    return T.period_table(f)


def _one_feature_ols(spark: SparkSession, d: str):
    o = T.period_table(T.om(spark, d).withColumns({"value_m": F.col("order_value") / MILLION,
                                                   "n_orders": F.col("n_orders").cast("double")}))
    return o, ML.fit_ols(o, ["n_orders"], "value_m")


def ols(spark: SparkSession, d: str) -> DataFrame:
    """ML-1 + ML-4: monthly order value (millions) on order count."""
    _, m = _one_feature_ols(spark, d)
    return ML.coefficients(spark, m, ["n_orders"]).select("term", F.round("estimate", 4).alias("estimate"))


def scenario(spark: SparkSession, d: str) -> DataFrame:
    """SCN-1..3: one more order per month, mean baseline / scenario / delta."""
    o, m = _one_feature_ols(spark, d)
    return SC.compare_scenarios({"linear": m}, o, {"n_orders": 1.0}, digits=4)


def scenario_range(spark: SparkSession, d: str) -> DataFrame:
    """SCN-4: how far a +25 order shock leaves the observed range."""
    return SC.extrapolation(T.om(spark, d), {"n_orders": 25.0})


def scenario_grid(spark: SparkSession, d: str) -> DataFrame:
    """SCN-5: predictions over the observed order-count range, step 1."""
    o, m = _one_feature_ols(spark, d)
    b = o.select(F.struct(F.min("n_orders").alias("lo"), F.max("n_orders").alias("hi"))).scalar()
    g = SC.scenario_grid({"n_orders": (b["lo"], b["hi"], 1.0)}, m, spark)
    return g.select(F.col("n_orders").cast("long").alias("n_orders"), F.round("prediction", 4).alias("prediction"))


def forest(spark: SparkSession, d: str) -> DataFrame:
    """ML-2 + ML-3: forest on lag features, trained on the first 80 %."""
    f = _model_frame(spark, d)
    m = ML.fit_forest(f.where(F.col("split") == "train"), LAG_FEATURES, "value_m")
    return ML.predict(m, f).select("year_month", "split", F.round("prediction", 4).alias("prediction"))


def model_metrics(spark: SparkSession, d: str) -> DataFrame:
    """CMP-12 / ML-6 / ML-7: OLS and forest on lag features, chronological
    split, metrics per (model, split)."""
    f = _model_frame(spark, d)
    train = f.where(F.col("split") == "train")
    models = {"linear": ML.fit_ols(train, LAG_FEATURES, "value_m"),
              "random_forest": ML.fit_forest(train, LAG_FEATURES, "value_m")}
    hold = ML.holdout_table(models, f, LAG_FEATURES, ["year_month", "split", "value_m"])
    return ML.metrics_table(hold, "value_m", ["linear_predicted", "random_forest_predicted"], keys=["split"])


# ------------------------------------------------- release cleaning plans

# Preamble lines of a statistical release export.
RELEASE_PREAMBLE = [("Title", "Average order value"), ("CDID", "AOV1"), ("Source dataset ID", "ORDERS"),
                    ("PreUnit", ""), ("Unit", "USD"), ("Release date", "01-01-2002"), ("Next release", ""),
                    ("Important notes", "")]


def _release_lines(spark: SparkSession, d: str) -> DataFrame:
    """A headerless two-column release derived from the monthly orders:
    preamble, annual, quarterly, stale monthly and monthly lines, with a
    file-order line number."""
    o = T.period_table(T.om(spark, d)).withColumns({"_m": F.to_date("year_month", "yyyy-MM"),
                                    "_v": F.col("order_value") / F.col("n_orders")})
    ordinal = D.month_ordinal(F.col("_m"))
    monthly = o.select(F.upper(F.date_format("_m", "yyyy MMM")).alias("_c0"), F.col("_v").cast("string").alias("_c1"),
                       (F.lit(400000) + ordinal).cast("long").alias("line"))
    stale = o.select(F.upper(F.date_format("_m", "yyyy MMM")).alias("_c0"), F.lit("0.0").alias("_c1"),
                     (F.lit(300000) + ordinal).cast("long").alias("line"))
    yearly = o.groupBy(F.year("_m").alias("y")).agg(F.avg("_v").alias("v"))
    annual = yearly.select(F.col("y").cast("string").alias("_c0"), F.round("v", 2).cast("string").alias("_c1"),
                           (F.lit(100000) + F.col("y")).cast("long").alias("line"))
    qs = o.groupBy(F.year("_m").alias("y"), F.quarter("_m").alias("q")).agg(F.avg("_v").alias("v"))
    quarterly = qs.select(F.concat(F.col("y").cast("string"), F.lit(" Q"), F.col("q").cast("string")).alias("_c0"),
                          F.round("v", 2).cast("string").alias("_c1"),
                          (F.lit(200000) + F.col("y") * 10 + F.col("q")).cast("long").alias("line"))
    pre = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(RELEASE_PREAMBLE)], "_c0 string, _c1 string, line long")
    return R.union_all([pre, annual, quarterly, stale, monthly])


def clean_release(spark: SparkSession, d: str) -> DataFrame:
    """CMP-1 (SRC-3, FLT-2, DT-1, PRJ-3, WIN-6, WIN-8, PRJ-2) over a release
    export derived from the monthly orders."""
    lines = _release_lines(spark, d)
    series = RL.select_series(lines, "average order")
    return RL.clean_monthly_release(series, n_months=60, geo_name="ALL", source_note="orders release")


def _rate_events(spark: SparkSession, d: str) -> DataFrame:
    li = T.read(spark, d, "lineitem")
    daily = li.groupBy(F.to_date("l_shipdate").alias("_d")).agg(F.round(T.exact_mean("l_tax") * 100, 4).alias("_r"))
    return daily.select(F.upper(F.date_format("_d", "dd MMM yy")).alias("Date Changed"),
                        F.col("_r").cast("string").alias("Rate"))


def month_end_rate(spark: SparkSession, d: str) -> DataFrame:
    """CMP-3 (SRC-4, DT-2 with two-digit years, PRJ-3, FLT-6, JN-3): daily
    mean tax as rate-change events, value in force at each shipping month's end."""
    events = T.period_table(_rate_events(spark, d).withColumn("month", F.trunc(D.parse_dayfirst("Date Changed"), "month")))
    out = RL.month_end_rate(events.drop("month"), events.select("month").distinct())
    return out.select("year_month", "rate")


def price_release(spark: SparkSession, d: str) -> DataFrame:
    """CMP-2 (SRC-4 second layout, DT-2, WIN-6, WIN-8) keyed by region:
    daily average order price per nation as a price file."""
    o = T.orders_with_nation(spark, d)
    n = T.read(spark, d, "nation").select(F.col("n_nationkey").alias("nation_key"), "n_name")
    daily = (o.groupBy("nation_key", F.to_date("o_orderdate").alias("_d"))
              .agg((T.money_sum("o_totalprice") / F.count(F.lit(1))).alias("_p"))
              .join(n, "nation_key"))
    raw = daily.select(F.date_format("_d", "dd/MM/yyyy").alias("Date"), F.col("n_name").alias("Region_Name"),
                       F.concat(F.lit("N"), F.col("nation_key").cast("string")).alias("Area_Code"),
                       F.col("_p").alias("Average_Price"), (F.col("_p") / 1000).alias("Index"))
    out = RL.clean_price_release(raw, n_months=60)
    return out.select("region", "year_month", "index", "average_price")


def income_release(spark: SparkSession, d: str) -> DataFrame:
    """CMP-4 (SRC-8, WIN-9, DT-9, WIN-6): the decile income table written as
    a wide fiscal-year release, read back to (decile, value, period end)."""
    dec = T.period_table(T.dec(spark, d))
    wide = A.pivot_wide(dec, ["year"], "decile", "income", list(range(1, 11)), name=lambda v: f"d{v}",
                        check_unique=False)
    labelled = wide.withColumn("period", F.concat(F.col("year").cast("string"), F.lit("-"),
                                                  F.lpad(((F.col("year") + 1) % 100).cast("string"), 2, "0")))
    long = RL.wide_income_to_long(labelled, "period", [f"d{i}" for i in range(1, 11)])
    return RL.income_by_decile(long, n_periods=5)


# --------------------------------------------------------------- ordering


def top_customers(spark: SparkSession, d: str) -> DataFrame:
    """SRT-3 + AGG-1: the 10 customers with the largest order value
    (customer key breaks ties), with their mean order."""
    o = T.read(spark, d, "orders")
    per = o.groupBy("o_custkey").agg(T.money_sum("o_totalprice").alias("order_value"),
                                     F.count(F.lit(1)).alias("n_orders"))
    return O.top_desc(per, "order_value", 10, tie_breakers=["o_custkey"]) \
            .withColumn("mean_order", F.col("order_value") / F.col("n_orders"))


def month_growth(spark: SparkSession, d: str) -> DataFrame:
    """MTH-2 + SRT-1 + QC-8: month-on-month growth of the order value,
    flagged when the order count leaves an allowed band."""
    o = S.lag_features(T.om(spark, d), {"order_value": [1]}, "year_month", drop_incomplete=False)  # month grain
    return O.sort_time(o.select("year_month", F.round(pct_change("order_value", "order_value_lag1"), 4).alias("growth_pct"),
                                (~F.col("n_orders").between(100, 100_000)).alias("count_outside_band")), ["year_month"])


MACRO_CONTRACT = Q.TableContract("monthly_macro", required=["year_month", "n_lines", "n_orders"], keys=["year_month"],
                                 numeric=["n_lines", "n_orders", "order_value"], month_column="year_month")


def contract_report(spark: SparkSession, d: str) -> DataFrame:
    """QC-9 / QC-11 as a table: the monthly panel's summary row (rows,
    duplicate months, coverage, malformed months)."""
    summary, _ = Q.validation_report(macro_merge(spark, d), MACRO_CONTRACT)
    return summary


def income_long_release(spark: SparkSession, d: str) -> DataFrame:
    """CMP-4 via the long layout (SRC-6 header normalisation, SRC-7 trim /
    coerce / population, component and decile filters, newest periods):
    the decile income table written as text rows with untidy headers and
    rows of other groups and components mixed in."""
    dec = T.period_table(T.dec(spark, d))
    label = F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(((F.col("year") + 1) % 100).cast("string"), 2, "0"))
    rows = dec.select(label.alias(" Financial Year Ending "), F.lit(" All households ").alias("GROUP"),
                      F.lit("Disposable income").alias("Component"),
                      F.concat(F.lit("Decile "), F.col("decile").cast("string")).alias("Decile group"),
                      F.concat(F.lit(" "), F.col("income").cast("string")).alias("GBP per year"))
    noise = rows.withColumn("GROUP", F.lit("Retired")).unionByName(
        rows.withColumn("Component", F.lit("Original income")))
    raw = RL.normalise_headers(rows.unionByName(noise), ["financial year ending", "group", "component",
                                                         "decile group", "gbp per year"])
    long = RL.long_income(raw, period="financial year ending", group="group", component="component",
                          decile="decile group", value="gbp per year", group_value="all households",
                          component_value="disposable income", latest=5)
    return RL.income_by_decile(long, n_periods=5)


# ------------------------------------------------- distributed orderings
ORDER_KEY = ["o_totalprice", "o_orderkey"]


def _priced_orders(spark: SparkSession, d: str) -> DataFrame:
    return T.read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", "o_orderdate")


def rank_orders(spark: SparkSession, d: str) -> DataFrame:
    """Global rank of all orders by price, with payload columns."""
    return S.global_rank(_priced_orders(spark, d), ORDER_KEY, rank_col="price_rank").drop("o_orderdate")


def rank_by_priority(spark: SparkSession, d: str) -> DataFrame:
    """Global rank restarting per order priority (five hot groups)."""
    return S.global_rank(_priced_orders(spark, d), ORDER_KEY, rank_col="price_rank", groups=["o_orderpriority"]).drop("o_orderdate")


def split_orders(spark: SparkSession, d: str) -> DataFrame:
    """WIN-10 unkeyed and keyed over all orders, distributed."""
    o = T.read(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    a = S.chronological_split(o, "o_orderkey", 0.8)
    b = S.chronological_split(a, "o_orderkey", 0.8, keys=["o_orderpriority"], out="priority_split", distributed=True)
    return b.select("o_orderkey", "o_totalprice", "split", "priority_split")


def lag_orders(spark: SparkSession, d: str) -> DataFrame:
    """WIN-1 distributed: each order's previous two prices in its priority."""
    o = T.read(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return S.lag_features(o, {"o_totalprice": [1, 2]}, "o_orderkey", keys=["o_orderpriority"], drop_incomplete=False, distributed=True)


def running_max_orders(spark: SparkSession, d: str) -> DataFrame:
    """WIN-2 distributed: highest price so far, over all orders and per priority."""
    o = T.read(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    whole = S.running_max(o, "o_totalprice", "o_orderkey", distributed=True).withColumnRenamed("o_totalprice_running_max", "whole_max")
    return S.running_max(whole, "o_totalprice", "o_orderkey", keys=["o_orderpriority"], distributed=True) \
            .withColumnRenamed("o_totalprice_running_max", "priority_max")


# ------------------------------------------------------------ more coverage
def rate_layouts(spark: SparkSession, d: str) -> DataFrame:
    """CMP-3 in both file layouts, with one and two digit days, two and four
    digit years, and rates that cannot be read (the month stays missing)."""
    daily = _rate_events(spark, d).withColumn("_d", D.parse_dayfirst("Date Changed"))
    bad = F.day("_d") % 7 == 0
    rate = F.when(bad, F.lit("n/a")).otherwise(F.col("Rate"))
    daily = T.period_table(daily.select("_d", rate.alias("Rate")))
    spine = daily.select(F.trunc("_d", "month").alias("month")).distinct()
    old = daily.select(F.date_format("_d", "dd MMM yy").alias("Date Changed"), "Rate")
    new = daily.select(F.when(F.day("_d") % 2 == 0, F.date_format("_d", "d MMMM yyyy")).otherwise(F.date_format("_d", "d/M/yyyy")).alias("DATE"),
                       F.col("Rate").alias("IUDBEDR"))
    both = [RL.month_end_rate(e, spine).select(F.lit(n).alias("layout"), "year_month", "rate") for n, e in (("old", old), ("new", new))]
    return R.union_all(both)


def contract_violations(spark: SparkSession, d: str) -> DataFrame:
    """QC-1..5, 7, 8 and 11 through the public functions: one row per check."""
    o, li = T.read(spark, d, "orders"), T.read(spark, d, "lineitem")
    Q.require_columns(o, ["o_orderkey", "o_totalprice"])
    Q.require_numeric(o, ["o_totalprice"])
    label = li.withColumn("label", F.when(F.col("l_linenumber") == 7, F.lit("2020-13")).otherwise(F.date_format("l_shipdate", "yyyy-MM")))
    gaps = li.withColumn("tax", F.when(F.col("l_linenumber") != 3, F.col("l_tax")))
    one = lambda df, name, n: df.select(F.lit(name).alias("check"), n.cast("long").alias("n"))
    return R.union_all([
        one(Q.duplicate_keys(li, ["l_orderkey"]), "duplicate_keys", F.col("duplicates")),
        one(Q.duplicate_keys(li, ["l_orderkey", "l_linenumber"]), "unique_keys", F.col("duplicates")),
        one(label.agg(F.count_if(Q.no_month("label")).alias("n")), "bad_months", F.col("n")),
        one(li.agg(Q.other_values("l_returnflag", ["A"]).alias("n")), "not_constant", F.col("n")),
        one(Q.allowed_values(o, "o_orderpriority", ["1-URGENT", "2-HIGH"]).agg(F.count(F.lit(1)).alias("n")), "not_allowed", F.col("n")),
        one(Q.missing_over_limit(gaps, {"tax": 10, "l_tax": 10}), "missing_over_limit", F.col("missing")),
    ])


def column_tools(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-1, PRJ-3..6, STR-1, STR-3..6, MTH-1, DT-5, DT-6, DT-12, SET-6."""
    o = R.project(T.read(spark, d, "orders"), {"o_orderkey": "order_id", "o_orderpriority": "priority", "o_orderdate": "day", "o_totalprice": "price"})
    o = R.derive(o, price_text=F.concat(F.lit(" "), F.col("price").cast("string")), tenth=F.col("order_id") % 10, code=F.concat(F.lit("Bulk_"), F.col("priority")),
                 share=(F.col("order_id") % 1000) / F.lit(8.0), bad=F.lit("x1"))
    o = R.coerce_numeric(o, ["price_text"])
    o = R.cast_types(o, {"bad": "int", "tenth": "int"})
    o = R.display_labels(o, "tenth", "price_cents", "share") if "price_cents" in o.columns else \
        R.display_labels(o.withColumn("whole", F.floor("price")), "tenth", "whole", "share")
    o = R.concat_columns(o, low=TF.norm_text(F.concat(F.lit("  "), F.col("code"))), urgent=TF.contains_text("code", "URGENT"),
                         digit=TF.regex_find("code", r"_(\d)-", 1), bulk=TF.has_prefix("code", "Bulk"), ends=TF.has_suffix("code", "LOW"),
                         title=TF.title_label(F.lower(F.col("code"))), rounded=TF.round_to(F.col("share"), 1),
                         month_end=_iso(D.month_end("day")), year=D.year_of("day"), iso=D.iso_date("day"))
    return o.drop("day", "whole", "price")


def row_tools(spark: SparkSession, d: str) -> DataFrame:
    """FLT-1, FLT-4, FLT-6, FLT-9, FLT-10, SET-2, SET-4, AGG-1, AGG-2, AGG-8
    and AGG-21 as counts and statistics, one row per measure."""
    o, c = T.read(spark, d, "orders"), T.read(spark, d, "customer")
    n = lambda df, name: df.agg(F.lit(name).alias("measure"), F.count(F.lit(1)).cast("double").alias("value"))
    cents = o.select("o_orderpriority", T.units("o_totalprice", 2).alias("cents"))
    stats = A.group_stats(cents, ["o_orderpriority"], "cents")
    means = A.group_mean(o.select("o_orderstatus", "o_custkey"), ["o_orderstatus"], "o_custkey", "value")
    return R.union_all([
        n(R.filter_eq(o, "o_orderstatus", "F"), "eq"), n(R.filter_between(o, "o_totalprice", 1000, 50000), "between"),
        n(R.drop_missing(o.withColumn("x", F.nullif(F.col("o_orderstatus"), F.lit("O"))), ["x"]), "not_missing"),
        n(R.implausible(o, "o_totalprice", 1000, 50000), "implausible"), n(R.threshold_rows(o, F.col("o_totalprice") > 100000, ["o_orderkey"]), "threshold"),
        n(R.intersect_keys(o.select(F.col("o_custkey").alias("k")), c.select(F.col("c_custkey").alias("k")), ["k"]), "shared_keys"),
        n(R.distinct_rows(o.select("o_orderstatus", "o_orderpriority")), "distinct_rows"), n(A.distinct_values(o, "o_orderpriority"), "distinct_values"),
        stats.select(F.concat(F.lit("min_"), F.col("o_orderpriority")).alias("measure"), F.col("min").cast("double").alias("value")),
        stats.select(F.concat(F.lit("max_"), F.col("o_orderpriority")).alias("measure"), F.col("max").cast("double").alias("value")),
        means.select(F.concat(F.lit("mean_"), F.col("o_orderstatus")).alias("measure"), F.round("value", 6).alias("value")),
    ])


def preview(spark: SparkSession, d: str) -> DataFrame:
    """SRT-4: a preview has as many rows as asked for, all of them the table's."""
    o = T.read(spark, d, "orders")
    first = T.period_table(O.head(o.select("o_orderkey", "o_totalprice"), 5))
    foreign = first.join(o, ["o_orderkey", "o_totalprice"], "left_anti")
    return first.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_foreign", foreign.select(F.count(F.lit(1))).scalar())


def frozen_values(spark: SparkSession, d: str) -> DataFrame:
    """QC-10: per order status, whether the mean of plain doubles reproduces the
    exact mean at two places, and whether one shifted by a cent does."""
    o = T.read(spark, d, "orders").groupBy("o_orderstatus").agg(F.avg("o_totalprice").alias("plain"), T.exact_mean("o_totalprice", 2).alias("exact"))
    return o.select("o_orderstatus", Q.expected_value("plain", "exact", 2).alias("reproduced"),
                    Q.expected_value(F.col("plain") + 0.01, F.col("exact"), 2).alias("shifted_reproduced"))


def null_keys(spark: SparkSession, d: str) -> DataFrame:
    """AGG-5, 6, 12, 15, 16, WIN-1, 9, 10 with a key that is null for one
    priority: the null group is a group like the others."""
    o = T.read(spark, d, "orders").select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p"), "o_totalprice", F.year("o_orderdate").alias("y"))
    o = T.period_table(o)
    key = F.coalesce("p", F.lit("none")).alias("p")
    n = lambda df, name: df.groupBy(key).agg(F.lit(name).alias("what"), F.count(F.lit(1)).cast("double").alias("value"))
    one = lambda df, name, c: df.select(key, F.lit(name).alias("what"), F.round(c, 4).alias("value"))
    split = S.chronological_split(o, "o_orderkey", 0.8, keys=["p"], distributed=True)
    lag = S.lag_features(o, {"o_totalprice": [1, 2]}, "o_orderkey", keys=["p"], distributed=True)
    ranks = A.average_rank(o, "o_totalprice", ["p"], "r").where(F.col("r").isNotNull())
    hist = A.histogram(o, "o_totalprice", 12, keys=["p"])
    return R.union_all([
        n(split.where("split = 'train'"), "train"), n(lag, "lagged"), n(ranks, "ranked"),
        n(S.latest_n_periods(o, "y", 2, keys=["p"]), "latest"),
        hist.groupBy(key).agg(F.lit("binned").alias("what"), F.sum("count").cast("double").alias("value")),
        one(A.describe(o, "o_totalprice", keys=["p"]), "p25", F.col("p25")),
        one(A.profile(o, ["o_totalprice"], keys=["p"]), "median", F.col("median")),
        one(A.sigma_outliers(o, ["o_totalprice"], 1.0, keys=["p"]), "outliers", F.col("outliers").cast("double")),
    ])


def label_scores(spark: SparkSession, d: str) -> DataFrame:
    """TXT-3: threshold labels of a precomputed score, both ends inclusive."""
    ev = T.read(spark, d, "events").select("event_id", (F.col("event_id") % 21 / F.lit(10.0) - 1).alias("score"))
    return TX.label_by_threshold(ev, "score", 0.5, -0.5)


def sorted_ranks(spark: SparkSession, d: str) -> DataFrame:
    """SRT-1, SRT-2: rows in order, each with its position, so that the order
    itself is compared. Positions come from the sorted rows (customer grain)."""
    c = T.read(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 5 > 0, F.col("c_acctbal")).alias("bal"))
    pos = lambda df, name: df.select("c_custkey", F.lit(name).alias("sort"), F.monotonically_increasing_id().alias("_i"))
    both = R.union_all([pos(O.sort_time(c, ["bal", "c_custkey"]), "time"), pos(O.sort_by_derived(c, [F.col("c_custkey") % 7, F.col("c_custkey")]), "derived")])
    both = S.global_rank(T.period_table(both), ["_i"], rank_col="position", groups=["sort"])
    return both.select("sort", "c_custkey", "position")


def ols_multi(spark: SparkSession, d: str) -> DataFrame:
    """ML-1 with two features, ML-4, and ML-7 metrics of the train and test
    months: ship value (millions) on lagged order count and mean discount."""
    m = T.lm(spark, d).join(T.om(spark, d), "year_month").select(
        "year_month", (F.col("ship_value") / 1e6).alias("y"), F.col("n_orders").cast("double").alias("x1"), (F.col("avg_discount") * 100).alias("x2"))
    s = T.period_table(S.chronological_split(m, "year_month", 0.8))  # one row per month
    model = ML.fit_ols(s.where("split = 'train'"), ["x1", "x2"], "y")
    coef = ML.coefficients(spark, model, ["x1", "x2"]).select(F.col("term").alias("name"), F.lit("estimate").alias("what"), F.col("estimate").alias("value"))
    met = ML.metrics_table(ML.predict(model, s), "y", ["prediction"])
    st = met.unpivot(["split"], ["mae", "rmse", "r2"], "what", "value").select(F.col("split").alias("name"), "what", "value")
    return R.union_all([coef.withColumn("value", F.round("value", 3)), st.withColumn("value", F.round("value", 3))])


def frozen_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """ML-8 through evaluate_frozen on the naive monthly predictors."""
    return ML.evaluate_frozen(T.period_table(_naive_predictions(spark, d)), "y_true", ["naive_last", "naive_mean3", "absent"], "naive_last")
