"""Null keys are a group like others; ranges stay even on ties."""

import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import series as S
from panelkit.operators import stats as A
from panelkit.operators import textscore as TX


@pytest.fixture(scope="module")
def keyed(spark):
    rnd = random.Random(1)
    rows = [(k, j, t, float(rnd.randint(0, 30)), float(rnd.randint(0, 9))) for k, j in (("a", 1), (None, 1), ("a", None), (None, None)) for t in range(10)]
    return spark.createDataFrame(rows, "k string, j int, t int, x double, y double").cache()


KEYS = ["k", "j"]


def filled(df):
    return df.withColumns({"k": F.coalesce("k", F.lit("none")), "j": F.coalesce("j", F.lit(-1))})


OPERATORS = {
    "split": lambda d: S.chronological_split(d, "t", 0.8, KEYS, distributed=True),
    "lag": lambda d: S.lag_features(d, {"x": [1, 3]}, "t", KEYS, distributed=True),
    "running_max": lambda d: S.running_max(d, "x", "t", KEYS, distributed=True),
    "latest_periods": lambda d: S.latest_n_periods(d, "t", 3, KEYS),
    "histogram": lambda d: A.histogram(d, "x", 4, KEYS),
    "describe": lambda d: A.describe(d, "x", KEYS),
    "profile": lambda d: A.profile(d, ["x", "y"], KEYS),
    "outliers": lambda d: A.sigma_outliers(d, ["x", "y"], 1.0, KEYS),
    "ranks": lambda d: A.average_rank(d, "x", KEYS),
    "spearman": lambda d: A.spearman_matrix(d, ["x", "y"], KEYS),
    "gap": lambda d: A.rank_linear_gap(d, ["x", "y"], 0.0, KEYS),
    "quantiles": lambda d: A.exact_quantiles(d, "x", [0.1, 0.5], KEYS),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_null_keys_equal_filled_keys(keyed, name):
    op = OPERATORS[name]
    show = lambda df: sorted(repr(tuple(r)) for r in df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]).collect())
    got, want = filled(op(keyed)), op(filled(keyed))
    assert got.columns == want.columns and show(got) == show(want)
    assert got.select(*KEYS).distinct().count() == 4


@pytest.mark.parametrize("name, window", [("split", lambda d: S.chronological_split(d, "t", 0.8, KEYS)),
                                          ("lag", lambda d: S.lag_features(d, {"x": [1, 3]}, "t", KEYS)),
                                          ("running_max", lambda d: S.running_max(d, "x", "t", KEYS))])
def test_distributed_forms_equal_window_forms(keyed, name, window):
    show = lambda df: sorted(map(repr, df.collect()))
    assert show(OPERATORS[name](keyed)) == show(window(keyed))


@pytest.mark.parametrize("share", [0.05, 0.5])
def test_ranges_stay_even_on_ties(spark, share):
    """One value in a part of the rows, whichever hash it has."""
    n, p = 20_000, 32
    for value in range(3):
        df = spark.range(n).select("id", F.when(F.col("id") % 100 < share * 100, F.lit(value)).otherwise(F.col("id") + 10).alias("t"))
        tied = S._tied(df)
        sizes = [r["count"] for r in tied.groupBy(S._range_id(tied, ["t", "_tie"], p).alias("r")).count().collect()]
        assert len(sizes) == p and max(sizes) < 3 * n / p
        a, b = (S.chronological_split(x, "t", 0.8) for x in (df, df.repartition(5)))
        assert a.exceptAll(b).isEmpty() and a.where("split = 'train'").count() == 0.8 * n


def test_ranges_follow_the_session(spark):
    df = spark.range(30_000)
    assert df.groupBy(S._range_id(df, ["id"], 700).alias("r")).count().count() == 700
    assert df.groupBy(S._range_id(df, ["id"], None).alias("r")).count().count() == 4


def test_long_lexicon_scores_like_a_short_one(spark):
    words = [f"w{i:03d}" for i in range(200)]
    df = spark.createDataFrame([(i, " ".join(words[i:i + 5])) for i in range(0, 200, 7)], "id int, t string")
    short = [(w, 0.25, TX.WORSENING) for w in words[:60]] + [(w, 0.5, TX.RELIEF) for w in words[60:120]]
    more = [(f"none{i}", 1.0, p) for p in (TX.WORSENING, TX.RELIEF) for i in range(TX.EXPRESSION_PHRASES)]
    assert TX.lexicon_score(df, "t", short).collect() == TX.lexicon_score(df, "t", short + more).collect()


def test_scorer_is_loaded_once_per_task(spark):
    def load():
        calls = []

        def score(s):
            calls.append(len(s))
            return s.str.len() + 1000 * (len(calls) == 0)
        return score

    df = spark.createDataFrame([(i, None if i == 3 else "x" * i) for i in range(50)], "id int, t string")
    assert [r.compound for r in TX.score_with(df, "t", load=load).orderBy("id").collect()] == [0.0 if i == 3 else float(i) for i in range(50)]
    with pytest.raises(ValueError):
        TX.score_with(df, "t")


def test_ranges_are_searched_in_plain_columns(spark):
    """The same range as by the one expression, with nulls and ties of a part of
    the key, never null, without lambdas, in a plan that does not list the limits."""
    df = spark.range(5_000).select(F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("g"), F.when(F.col("id") % 7 > 0, F.col("id") / 3).alias("x"), "id")
    for p in (2, 3, 64, 500):
        s = S._ranged(df, ["x", "id"], ["g"], p)
        assert s.columns == [*df.columns, "_pid", "_g"] and not s.schema["_pid"].nullable
        assert s.where(F.col("_pid") != S._range_id(df, ["g", "x", "id"], p)).isEmpty() and s.select("_pid").distinct().count() == p
        plan = s._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in plan and len(plan) < 20_000
    assert S._ranged(df.limit(0), ["x", "id"], ["g"], 8).count() == 0
