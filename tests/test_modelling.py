import pytest
from pyspark.sql import functions as F

from panelkit.operators import modelling as ML
from panelkit.operators import scenario as SC


@pytest.fixture()
def linear(spark):
    rows = [(float(i), float(i % 7), 3.0 + 2.0 * i - 0.5 * (i % 7)) for i in range(40)]
    return spark.createDataFrame(rows, "x1 double, x2 double, y double")


def test_ols_recovers_coefficients(spark, linear):
    m = ML.fit_ols(linear, ["x1", "x2"], "y")
    c = {r.term: r.estimate for r in ML.coefficients(spark, m, ["x1", "x2"]).collect()}
    assert c["intercept"] == pytest.approx(3.0) and c["x1"] == pytest.approx(2.0) and c["x2"] == pytest.approx(-0.5)


def test_scenario_linear_delta_is_coefficient(spark, linear):
    m = ML.fit_ols(linear, ["x1", "x2"], "y")
    s = SC.score_scenario(m, linear, {"x1": 1.0})
    assert all(abs(r.delta - 2.0) < 1e-9 for r in s.collect())
    comp = SC.compare_scenarios({"linear": m}, linear, {"x1": 1.0}).first()
    assert comp.mean_delta == 2.0 and comp.n_rows == 40
    ext = SC.extrapolation(linear, {"x1": 5.0}).first()
    assert ext.observed_max == 39.0 and ext.shocked_max == 44.0 and ext.out_of_range and ext.rows_out_of_range == 5


def test_forest_metrics_and_holdout(spark, linear):
    train = linear.where("x1 < 32")
    models = {"linear": ML.fit_ols(train, ["x1", "x2"], "y"),
              "random_forest": ML.fit_forest(train, ["x1", "x2"], "y", num_trees=20)}
    hold = ML.holdout_table(models, linear.withColumn("split", F.when(F.col("x1") < 32, "train").otherwise("test")),
                            ["x1", "x2"], ["x1", "split", "y"])
    assert set(hold.columns) == {"x1", "split", "y", "linear_predicted", "random_forest_predicted"}
    met = {(r.model, r.split): r for r in ML.metrics_table(hold, "y", ["linear_predicted", "random_forest_predicted"]).collect()}
    assert met[("linear_predicted", "test")].mae == 0.0 and met[("random_forest_predicted", "train")].n_rows == 32
    imp = ML.importances(spark, models["random_forest"], ["x1", "x2"]).collect()
    assert imp[0].feature == "x1" and imp[0].rank == 1
    res = ML.residuals(hold.withColumn("t", F.make_date(F.lit(2024), F.lit(1), F.lit(1))), "t", "y", ["linear_predicted"],
                       roles={"linear_predicted": "baseline"}).first()
    assert res.quarter == "2024Q1" and res.model_role == "baseline"


def test_scenario_grid(spark, linear):
    m = ML.fit_ols(linear, ["x1", "x2"], "y")
    g = SC.scenario_grid({"x1": (0.0, 1.0, 0.25)}, m, spark, share={"x1": ["x2"]})
    assert g.count() == 5 and g.orderBy("x1").first().prediction == pytest.approx(3.0)


def test_model_roundtrip(spark, linear, tmp_dir):
    m = ML.fit_ols(linear, ["x1", "x2"], "y")
    ML.save_model(m, f"{tmp_dir}/m")
    back = ML.load_model(f"{tmp_dir}/m")
    assert back.transform(linear).first().prediction == pytest.approx(m.transform(linear).first().prediction)


def test_mortgage_and_burden(spark):
    prices = spark.createDataFrame([("2024-01", 280000.0), ("2024-02", 290000.4)], "t string, p double")
    b = SC.mortgage_benchmark(prices, "p", "t").first()
    assert b.balance == 217500.0 and b.extra_annual_cost == 2175.0
    inc = spark.createDataFrame([(1, 11590.0), (2, 0.0)], "decile int, income double")
    got = {r.decile: r.burden_share for r in SC.burden_by_group(inc, F.lit(2175.0)).collect()}
    assert got == {1: 18.77, 2: None}


def test_evaluate_frozen(spark):
    h = spark.createDataFrame([(1.0, 1.5, 1.0), (2.0, 2.5, 2.0), (3.0, 2.0, 3.5)], "y double, linear double, rf double")
    out = {r.model: r for r in ML.evaluate_frozen(h, "y", ["linear", "rf", "absent"], "linear").collect()}
    assert out["linear"].mae_improvement == 0.0 and out["rf"].mae == 0.167 and out["rf"].mae_improvement == 0.5


def test_mortgage_fallback(spark):
    empty = spark.createDataFrame([], "t string, p double")
    r = SC.mortgage_benchmark(empty, "p", "t", fallback_price=200000.0).first()
    assert r.extra_annual_cost == 1500.0 and r.source == "fallback"
