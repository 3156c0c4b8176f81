import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import stats as A


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(5)
    rows = [(g, float(rnd.randint(0, 40))) for g in "xyz" for _ in range(rnd.randint(1, 60))]
    df = spark.createDataFrame(rows, "g string, v double")
    qs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r.g: [r[f"q{i}"] for i in range(len(qs))] for r in A.exact_quantiles(df, "v", qs, groups=["g"]).collect()}
    for g in "xyz":
        vals = [v for gg, v in rows if gg == g]
        assert got[g] == pytest.approx(list(np.percentile(vals, [q * 100 for q in qs])))
    whole = A.exact_quantiles(df, "v", [0.5]).first().q0
    assert whole == pytest.approx(np.median([v for _, v in rows]))


def test_profile_and_describe(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, None), (3.0, 30.0), (10.0, 40.0)], "a double, b double")
    p = {r.column: r for r in A.profile(df, ["a", "b"]).collect()}
    assert p["a"]["count"] == 4 and p["a"]["median"] == 2.5 and p["b"]["count"] == 3 and p["b"]["median"] == 30.0
    assert p["a"]["std"] == pytest.approx(np.std([1, 2, 3, 10], ddof=1))
    d = A.describe(df, "a").first()
    assert (d.p25, d.p50, d.p75) == (1.75, 2.5, 4.75)


def test_pearson_constant_column_is_null_and_spearman_ties(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 5.0, 5.0), (4.0, 4.0, 5.0)], "x double, y double, c double")
    p = {(r.a, r.b): r.r for r in A.pearson_matrix(df, ["x", "y", "c"]).collect()}
    assert p[("x", "c")] is None and p[("x", "y")] == pytest.approx(np.corrcoef([1, 2, 3, 4], [2, 4, 5, 4])[0, 1])
    s = {(r.a, r.b): r.r for r in A.spearman_matrix(df, ["x", "y"]).collect()}
    ranks_y = [1, 2.5, 4, 2.5]
    assert s[("x", "y")] == pytest.approx(np.corrcoef([1, 2, 3, 4], ranks_y)[0, 1])


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (12.0,), (None,)], "v double")
    h = {r.bin: r["count"] for r in A.histogram(df, "v", bins=12).collect()}
    assert h == {1: 1, 2: 1, 6: 1, 12: 1}
    same = A.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v").collect()
    assert [(r.bin, r["count"]) for r in same] == [(1, 2)]


def test_sigma_outliers(spark):
    vals = [10.0] * 30 + [100.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = A.sigma_outliers(df, ["v"], k=3).first()
    m, s = np.mean(vals), np.std(vals, ddof=1)
    assert r.outliers == 1 and r.upper == pytest.approx(m + 3 * s)


def test_regression_metrics(spark):
    df = spark.createDataFrame([("m", 1.0, 2.0), ("m", 2.0, 2.0), ("m", 3.0, 3.0), ("c", 1.0, 1.0), ("c", 1.0, 2.0)],
                               "model string, y double, p double")
    got = {r.model: r for r in A.regression_metrics(df, "y", "p", keys=["model"]).collect()}
    assert got["m"].mae == 0.333 and got["m"].rmse == 0.577 and got["m"].r2 == 0.5
    assert got["c"].r2 is None  # SStot = 0


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("b",), ("c",), ("c",), ("c",), (None,), ("a",)], "l string")
    got = [(r.label, r["count"]) for r in A.value_counts(df, "l", preferred=["a", "b"]).orderBy("order_rank").collect()]
    assert got == [("a", 1), ("b", 2), ("c", 3), ("unknown", 1)]


def test_pivot_duplicates_raise(spark):
    df = spark.createDataFrame([(1, 2021, 1.0), (1, 2021, 2.0)], "d int, y int, v double")
    with pytest.raises(ValueError):
        A.pivot_wide(df, ["d"], "y", "v", [2021])
    ok = A.pivot_wide(df.limit(1), ["d"], "y", "v", [2021, 2022], name=lambda y: f"y{y}").first()
    assert ok.y2021 == 1.0 and ok.y2022 is None


def test_coverage_and_argmax(spark):
    df = spark.createDataFrame([("2021-01", 3.0), ("2021-02", 5.0), ("2021-03", 5.0)], "t string, v double")
    c = A.coverage(df, F.col("t")).first()
    assert c.coverage == "2021-01 to 2021-03" and c.unique_periods
    empty = A.coverage(df.where("false"), F.col("t")).first()
    assert empty.coverage == "no rows"
    a = A.argmax_row(df.withColumn("d", F.to_date("t", "yyyy-MM")), "v", "d", cols=["t"]).first()
    assert a.max_t == "2021-02"


def test_extremes_ratio(spark):
    df = spark.createDataFrame([(1, 18.77), (5, 5.0), (10, 1.86)], "d int, s double")
    assert A.extremes_ratio(df, "d", "s", 1, 10).first().ratio == pytest.approx(18.77 / 1.86)


def test_average_rank_distributed_matches_window(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice("ab"), float(rnd.randint(0, 12)), i) for i in range(300)] + [("a", None, 999)]
    df = spark.createDataFrame(rows, "k string, v double, id int")
    d = {r.id: r.v_rank for r in A.average_rank(df, "v", ["k"]).collect()}
    w = {r.id: r.v_rank for r in A.average_rank(df, "v", ["k"], method="window").collect()}
    assert d == w and d[999] is None
    s1 = {(r.a, r.b): r.r for r in A.spearman_matrix(df.withColumn("u", F.col("id") % 7), ["v", "u"]).collect()}
    s2 = {(r.a, r.b): r.r for r in A.spearman_matrix(df.withColumn("u", F.col("id") % 7), ["v", "u"], method="window").collect()}
    assert s1[("v", "u")] == pytest.approx(s2[("v", "u")])


def test_group_stats_distinct_and_argmin(spark):
    df = spark.createDataFrame([(1, 2.0, "2021-01"), (1, 4.0, "2021-02"), (2, None, "2021-01"), (2, 1.0, "2021-03")],
                               "d int, v double, t string")
    g = {r.d: (r.mean, r.min, r.max) for r in A.group_stats(df, ["d"], "v").collect()}
    assert g == {1: (3.0, 2.0, 4.0), 2: (1.0, 1.0, 1.0)}
    assert sorted(r.d for r in A.distinct_values(df, "d").collect()) == [1, 2]
    lo = {r.d: r.min_t for r in A.argmax_row(df, "v", "t", keys=["d"], cols=["t"], largest=False, prefix="min_").collect()}
    assert lo == {1: "2021-01", 2: "2021-03"}
    m = A.group_mean(df, ["d"], "v").where("d = 2").first()
    assert m.mean_v == 1.0
