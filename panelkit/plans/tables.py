"""Driver tables and the base panels the queries share.

``om``  orders by month of o_orderdate
``lm``  lineitem by month of l_shipdate
``np``  orders by (nation, month)
``dec`` customer income deciles: ntile(10) over (c_acctbal, c_custkey);
        group income = mean yearly order total of the decile's customers
Money goes through decimal(18,2) before summing, so totals do not depend on
summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.functions.dates import year_month
from panelkit.operators.series import ntile
from panelkit.session import cut_lineage

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def money(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def units(c, digits: int = 2) -> Column:
    """A short-decimal measure as an exact integer count of 10^-digits
    units (cents for money): long sums are exact and fast, where decimal
    sums above 18 digits fall back to BigDecimal arithmetic."""
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x * F.lit(float(10 ** digits))).cast("long")


def money_sum(c) -> Column:
    """Exact sum of a 2-decimal money column as a double: integer cents are
    summed, then divided once (the double nearest the exact decimal sum,
    independent of summation order and partitioning)."""
    return F.sum(units(c, 2)) / F.lit(100.0)


def exact_mean(c, digits: int = 4) -> Column:
    """Mean of a short-decimal measure: exact unit sum, then one division
    by the scale and one by the count."""
    x = F.col(c) if isinstance(c, str) else c
    return F.sum(units(x, digits)) / F.lit(float(10 ** digits)) / F.count(x)


def month_key(c) -> Column:
    """Group on the month as a date (cheap); format 'yyyy-MM' after the
    aggregate, on one row per month."""
    return F.trunc(F.to_date(F.col(c) if isinstance(c, str) else c), "month")


def om(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    return (o.groupBy(month_key("o_orderdate").alias("_m"))
             .agg(F.count(F.lit(1)).alias("n_orders"), money_sum("o_totalprice").alias("order_value"))
             .select(year_month("_m").alias("year_month"), "n_orders", "order_value"))


def lm(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem")
    return (li.groupBy(month_key("l_shipdate").alias("_m"))
              .agg(F.count(F.lit(1)).alias("n_lines"),
                   F.sum("l_quantity").alias("qty"),
                   money_sum("l_extendedprice").alias("ship_value"),
                   exact_mean("l_discount").alias("avg_discount"),
                   exact_mean("l_tax").alias("avg_tax"))
              .select(year_month("_m").alias("year_month"), "n_lines", "qty", "ship_value", "avg_discount", "avg_tax"))


def orders_with_nation(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation_key"))
    return o.join(c, "o_custkey")


def np_panel(spark: SparkSession, d: str) -> DataFrame:
    return (orders_with_nation(spark, d)
            .groupBy("nation_key", month_key("o_orderdate").alias("_m"))
            .agg(F.count(F.lit(1)).alias("n_orders"), money_sum("o_totalprice").alias("order_value"))
            .select("nation_key", year_month("_m").alias("year_month"), "n_orders", "order_value"))


def deciles(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select("c_custkey", "c_acctbal")
    return ntile(c, ["c_acctbal", "c_custkey"], 10, out="decile").select("c_custkey", "decile")


def dec(spark: SparkSession, d: str) -> DataFrame:
    """(decile, year, income): mean yearly order total per ordering customer."""
    o = read(spark, d, "orders")
    yearly = (o.groupBy("o_custkey", F.year("o_orderdate").alias("year"))
               .agg(F.sum(units("o_totalprice", 2)).alias("cents")))
    j = yearly.join(deciles(spark, d).withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    return (j.groupBy("decile", "year")
             .agg((F.sum("cents") / F.lit(100.0) / F.count(F.lit(1))).alias("income")))


def yearly_tax_rate(spark: SparkSession, d: str) -> DataFrame:
    """AGG-1 input of the price level: mean l_tax per ship year, in percent."""
    li = read(spark, d, "lineitem")
    return (li.groupBy(F.year("l_shipdate").alias("year"))
              .agg((exact_mean("l_tax") * 100).alias("rate")))


def period_table(df: DataFrame) -> DataFrame:
    """Materialise a period-grain result (deciles x years, one row per year)
    that a composite plan references several times. Its size is bounded by
    the calendar, so a reliable checkpoint in the shared checkpoint folder
    is cheap, survives executor loss and stops the heavy lineage (scans,
    ranking, joins) from being re-planned inside every subquery."""
    return cut_lineage(df)
