import pytest
from pyspark.sql import functions as F

from panelkit.operators import relational as R


def test_coerce_numeric(spark):
    df = spark.createDataFrame([(" 4.5 ",), ("x",), ("NaN",), (None,)], "v string")
    assert [r.v for r in R.coerce_numeric(df, ["v"]).collect()] == [4.5, None, None, None]


def test_filters(spark):
    df = spark.createDataFrame([("2023 JAN", "a"), ("2023", "B"), ("2023 Q1", None), ("2023-24", "b")], "l string, c string")
    assert [r.l for r in R.filter_fullmatch(df, "l", R.MONTHLY_LABEL).collect()] == ["2023 JAN"]
    assert {r.l for r in R.filter_fullmatch(df, "l", R.ANNUAL_LABEL).collect()} == {"2023", "2023-24"}
    assert {r.l for r in df.where(R.ieq("c", "b")).collect()} == {"2023", "2023-24"}
    assert R.drop_blank(spark.createDataFrame([(" ",), (None,), ("x",)], "t string"), "t").count() == 1
    with pytest.raises(ValueError):
        R.filter_eq(df, "c", "zzz", require_rows=True)


def test_search_any_column_is_regex_and_case_insensitive(spark):
    df = spark.createDataFrame([(1, "Steel pipe", 2.5), (2, None, 12.0), (3, "wood", None)], "id int, n string, p double")
    assert [r.id for r in R.search_any_column(df, "steel|^12").collect()] == [1, 2]
    assert R.search_any_column(df, "a.b").count() == 0


def test_mark_absent_and_shared(spark):
    a = spark.createDataFrame([("2021-01", 1.0), ("2021-02", 2.0), ("2021-03", 3.0)], "m string, x double")
    b = spark.createDataFrame([("2021-02", 5.0), ("2021-03", 6.0), ("2021-04", 7.0)], "m string, y double")
    flags = {r.m: r.absent for r in R.mark_absent(a, b, ["m"]).collect()}
    assert flags == {"2021-01": True, "2021-02": False, "2021-03": False}
    sa, sb = R.shared_periods(a, b, ["m"])
    assert sorted(r.m for r in sa.collect()) == sorted(r.m for r in sb.collect()) == ["2021-02", "2021-03"]


def test_versus_baseline(spark):
    m = spark.createDataFrame([("base", 2.0, 3.0, 0.5), ("rf", 1.0, 1.5, 0.9)], "model string, mae double, rmse double, r2 double")
    got = {r.model: (r.mae_improvement, r.rmse_improvement, r.r2_improvement) for r in R.versus_baseline(m, "model", "base").collect()}
    assert got == {"base": (0.0, 0.0, 0.0), "rf": (1.0, 1.5, 0.4)}
    none = R.versus_baseline(m, "model", "absent").collect()
    assert all(r.mae_improvement is None for r in none)


def test_unpivot_requires_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "t int, a double")
    assert R.unpivot_columns(df, ["t"], ["a", "zz"], "model", "v").count() == 1
    with pytest.raises(ValueError):
        R.unpivot_columns(df, ["t"], ["zz"])


def test_aligned_arith(spark):
    df = spark.createDataFrame([(1, 2021, 10.0), (1, 2024, 12.0), (2, 2021, 5.0)], "g int, y int, v double")
    got = {r.g: r.result for r in R.aligned_arith(df, ["g"], "y", "v", 2021, 2024).collect()}
    assert got == {1: 1.2, 2: None}


def test_phrase_hits(spark):
    df = spark.createDataFrame([("current rent",)], "t string")
    assert df.select(R.phrase_hits(F.col("t"), ["rent", "cur", "zzz"]).alias("h")).first().h == ["rent", "cur"]


def test_display_labels_and_threshold_rows(spark):
    df = spark.createDataFrame([(1, 2013.4, 18.77), (10, 108000.0, 1.86)], "decile int, cost double, share double")
    r = R.display_labels(df, "decile", "cost", "share").orderBy("decile").collect()
    assert (r[0].decile_label, r[0].cost_label, r[0].share_label) == ("D1", "£2,013", "18.8%")
    assert r[1].cost_label == "£108,000" and r[1].share_label == "1.9%"
    assert [x.decile for x in R.threshold_rows(df, F.col("share") < 5, ["decile"]).collect()] == [10]
