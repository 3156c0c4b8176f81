import pytest
from pyspark.sql import functions as F

from panelkit.operators import quality as Q


def test_missingness_structural_accidental(spark):
    df = spark.createDataFrame([("2021-01", None, 1.0, True), ("2021-02", None, None, False), ("2021-03", 2.0, float("nan"), False)],
                               "m string, a double, b double, absent boolean")
    out = {r.column: (r.total, r.structural, r.accidental) for r in
           Q.missingness(df, ["a", "b"], structural={"a": F.col("absent"), "b": F.lit(None).cast("boolean")}).collect()}
    assert out == {"a": (2, 1, 1), "b": (2, 0, 2)}


def test_validate_contract(spark):
    df = spark.createDataFrame([("2021-01", 1.0, "UK"), ("2021-02", None, "UK")], "year_month string, v double, geo string")
    c = Q.TableContract("t", required=["year_month", "v"], keys=["year_month"], numeric=["v"], constants={"geo": "UK"},
                        month_column="year_month", max_missing={"v": 1})
    rep = Q.validate(df, c)
    assert rep["rows"] == 2 and rep["duplicates"] == 0 and rep["coverage"] == "2021-01 to 2021-02"
    dup = df.unionByName(df.limit(1))
    with pytest.raises(Q.ContractError):
        Q.validate(dup, c)
    with pytest.raises(Q.ContractError):
        Q.validate(df.withColumn("year_month", F.lit("2021-13")), c)
    with pytest.raises(Q.ContractError):
        Q.require_columns(df, ["missing"])
    with pytest.raises(Q.ContractError):
        Q.require_numeric(df, ["geo"])


def test_duplicate_keys_and_bad_months(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "k string")
    r = Q.duplicate_keys(df, ["k"]).first()
    assert (r.rows, r.distinct_keys, r.duplicates) == (4, 2, 2)
    m = spark.createDataFrame([("2021-01",), ("2021-1",), ("Jan",)], "m string")
    assert sorted(x.m for x in Q.bad_months(m, "m").collect()) == ["2021-1", "Jan"]


def test_missing_over_limit(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    assert [r.column for r in Q.missing_over_limit(df, {"a": 1, "b": 1}).collect()] == ["a"]


def test_monthly_macro_with_structural_rule(spark):
    from panelkit.plans.analyses import monthly_macro
    a = spark.createDataFrame([("2021-01", 1.0), ("2021-02", 2.0), ("2021-03", 3.0)], "year_month string, x double")
    b = spark.createDataFrame([("2021-01", 5.0), ("2021-02", 6.0), ("2021-03", 7.0), ("2021-04", 8.0)], "year_month string, y double")
    c = spark.createDataFrame([("2021-02", 1.5), ("2021-03", None)], "year_month string, z double")
    contract = Q.TableContract("macro", required=["year_month", "x", "y", "z"], keys=["year_month"],
                               month_column="year_month", constants={"geo": "UK"})
    panel, miss = monthly_macro(a, inner=[b], left=[c], stamp={"geo": "UK"}, structural_for=[c], validate_with=contract)
    assert panel.count() == 3 and "_absent0" not in panel.columns
    m = {r.column: (r.total, r.structural, r.accidental) for r in miss.collect()}
    assert m["z"] == (2, 1, 1) and m["x"] == (0, 0, 0)


def test_validation_report_tables(spark):
    df = spark.createDataFrame([("2021-01", 1.0), ("2021-01", None), ("2021-03", 2.0)], "year_month string, v double")
    c = Q.TableContract("t", required=["year_month", "v"], keys=["year_month"], month_column="year_month",
                        structural={"v": F.col("year_month") == "2021-01"})
    summary, miss = Q.validation_report(df, c)
    s = summary.first()
    assert (s.dataset, s.rows, s.duplicates, s.coverage, s.bad_months) == ("t", 3, 1, "2021-01 to 2021-03", 0)
    assert [(r.column, r.total, r.structural, r.accidental) for r in miss.collect()] == [("v", 1, 1, 0)]


def test_observed_count_and_clean_log(spark, tmp_dir):
    df = spark.range(25)
    observed, obs = Q.observe_counts(df)
    observed.write.mode("overwrite").parquet(f"{tmp_dir}/o")  # the count rides on the write, no second scan
    assert obs.get["rows"] == 25
    log = Q.clean_log(spark, [{"dataset": "inflation", "rows_in": 639, "rows_out": 60, "duplicates": 0,
                               "coverage": "2021-03 to 2026-02"}])
    r = log.first()
    assert (r.dataset, r.rows_in, r.rows_out, r.duplicates) == ("inflation", 639, 60, 0)


def test_require_months_formats_or_raises(spark):
    df = spark.createDataFrame([("2020-1",), ("2020-02",), ("2020-03-31",)], "m string")
    assert [r.m for r in Q.require_months(df, "m").collect()] == ["2020-01", "2020-02", "2020-03"]
    with pytest.raises(Q.ContractError, match="2020-13"):
        Q.require_months(spark.createDataFrame([("2020-13",)], "m string"), "m")


def test_validate_reports_missingness_and_other_values(spark):
    df = spark.createDataFrame([("2020-01", None, "a", True), ("2020-02", 1.0, "b", False)], "m string, v double, c string, absent boolean")
    c = Q.TableContract(name="t", required=["m", "v"], keys=["m"], constants={"c": "a"}, structural={"v": F.col("absent")})
    rep = Q.validate(df, c, raise_on_error=False)
    assert rep["missing"]["v"] == (1, 1, 0) and len(rep["problems"]) == 1 and "1 of 2" in rep["problems"][0]


def test_monthly_macro_validates_with_structural_rules(spark):
    from panelkit.plans.analyses import monthly_macro
    base = spark.createDataFrame([("2020-01", 1.0), ("2020-02", 2.0)], "year_month string, a double")
    other = spark.createDataFrame([("2020-01", 5.0)], "year_month string, b double")
    c = Q.TableContract(name="macro", required=["year_month"], keys=["year_month"])
    panel, miss = monthly_macro(base, left=[other], structural_for=[other], validate_with=c)
    assert panel.columns == ["year_month", "a", "b"]
    assert {r.column: (r.total, r.structural) for r in miss.collect()}["b"] == (1, 1)
