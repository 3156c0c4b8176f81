import random

import pytest
from pyspark.sql import Window, functions as F

from panelkit.operators import series as S
from tests.conftest import plan_text


@pytest.fixture()
def panel(spark):
    rows = [("a", f"2021-{m:02d}", float(v)) for m, v in zip(range(1, 7), [5, 7, 6, 9, 9, 4])]
    rows += [("b", f"2021-{m:02d}", v) for m, v in zip(range(1, 4), [None, 2.0, 3.0])]
    return spark.createDataFrame(rows, "k string, t string, v double")


def test_lag_features_rows_not_calendar(panel):
    out = S.lag_features(panel, {"v": [1, 3]}, "t", keys=["k"]).orderBy("k", "t").collect()
    assert [(r.k, r.t, r.v_lag1, r.v_lag3) for r in out] == [("a", "2021-04", 6.0, 5.0), ("a", "2021-05", 9.0, 7.0),
                                                             ("a", "2021-06", 9.0, 6.0)]


def test_running_max_and_index(panel):
    rm = {(r.k, r.t): r.v_running_max for r in S.running_max(panel, "v", "t", keys=["k"]).collect()}
    assert rm[("a", "2021-06")] == 9.0 and rm[("a", "2021-03")] == 7.0
    idx = {(r.k, r.t): r.v_index for r in S.index100(panel, ["v"], "t", keys=["k"]).collect()}
    assert idx[("a", "2021-01")] == 100.0 and idx[("a", "2021-04")] == 180.0
    assert idx[("b", "2021-02")] is None  # missing first value -> whole index missing
    base = {(r.k, r.t): r.v_index for r in S.index100(panel, ["v"], "t", keys=["k"], base_time="2021-02").collect()}
    assert base[("a", "2021-04")] == pytest.approx(9 / 7 * 100)


def test_price_level(spark):
    df = spark.createDataFrame([(2021, 99.0), (2022, 7.9), (2023, 6.83), (2024, 3.29)], "year int, rate double")
    got = [r.price_level for r in S.price_level(df, "rate", "year", 2021).orderBy("year").collect()]
    assert got == [1.0, 1.079, 1.1527, 1.1906]


def test_gap_check(spark):
    df = spark.createDataFrame([("x", "2021-01-01"), ("x", "2021-02-01"), ("x", "2021-04-01")], "k string, d string") \
              .withColumn("d", F.to_date("d"))
    out = S.gap_check(df, "d", keys=["k"]).collect()
    assert len(out) == 1 and out[0].gap == 2


def test_keep_last_first_with_ties(spark):
    df = spark.createDataFrame([(1, "2021-01", 1, "old"), (1, "2021-01", 2, "new"), (2, "2021-02", 1, "only")],
                               "k int, t string, seq int, v string")
    last = {r.k: r.v for r in S.keep_last(df, ["k"], ["t", "seq"]).collect()}
    first = {r.k: r.v for r in S.keep_first(df, ["k"], ["t", "seq"]).collect()}
    assert last == {1: "new", 2: "only"} and first == {1: "old", 2: "only"}
    assert S.duplicate_count(df, ["k"]).first().duplicates == 1


def test_latest_n_and_periods(spark, panel):
    assert [r.t for r in S.latest_n(panel, "t", 2, keys=["k"]).where("k = 'a'").orderBy("t").collect()] == ["2021-05", "2021-06"]
    df = spark.createDataFrame([(p, d) for p in ["2019-20", "2020-21", "2021-22", "2018-19"] for d in (1, 2)], "p string, d int")
    from panelkit.functions.dates import fiscal_period_start
    got = S.latest_n_periods(df, fiscal_period_start("p"), 2)
    assert sorted({r.p for r in got.collect()}) == ["2020-21", "2021-22"] and got.count() == 4


def test_chronological_split_keyed_and_unkeyed(spark):
    df = spark.createDataFrame([(f"2021-{m:02d}",) for m in range(1, 11)] + [(f"2022-{m:02d}",) for m in range(1, 6)], "t string")
    a = {r.t: r.split for r in S.chronological_split(df, "t", 0.8).collect()}
    b = {r.t: r.split for r in S.chronological_split(df.withColumn("k", F.lit(1)), "t", 0.8, keys=["k"]).collect()}
    assert a == b and sum(v == "train" for v in a.values()) == 12
    assert max(t for t, s in a.items() if s == "train") < min(t for t, s in a.items() if s == "test")


def test_global_rank_matches_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 5), rnd.random(), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, x double, id int")
    got = {r.id: r.rank for r in S.global_rank(df, ["x", "id"], partitions=7).collect()}
    want = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy("x", "id"))).collect()}
    assert got == want
    got_g = {r.id: r.rank for r in S.global_rank(df, ["x", "id"], partitions=5, groups=["g"]).collect()}
    want_g = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("x", "id"))).collect()}
    assert got_g == want_g


def test_ntile_matches_sql(spark):
    for n in (7, 10, 23, 101):
        df = spark.range(n).withColumn("x", (F.col("id") * 37 % 11).cast("double"))
        got = {r.id: r.tile for r in S.ntile(df, ["x", "id"], 10).collect()}
        want = {r.id: r.t for r in df.withColumn("t", F.ntile(10).over(Window.orderBy("x", "id"))).collect()}
        assert got == want


def test_global_rank_with_payload_at_scale(spark):
    """A million rows with payload columns and a group that holds a third."""
    df = spark.range(1_000_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"),
        (F.xxhash64("id") % 1000).alias("x"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    for groups in ([], ["g"]):
        got = S.global_rank(df, ["x", "id"], groups=groups, partitions=16)
        assert got.columns == [*df.columns, "rank"]
        want = df.select("id", F.row_number().over(Window.partitionBy(*groups, F.lit(0)).orderBy("x", "id")).alias("want"))
        wrong = got.join(want, "id", "full").where("rank <> want or rank is null or want is null or payload <> sha2(cast(id as string), 256)")
        assert wrong.count() == 0
    tiles = S.ntile(df, ["x", "id"], 10).groupBy("tile").count().collect()
    assert sorted((r["tile"], r["count"]) for r in tiles) == [(i, 100_000) for i in range(1, 11)]
    split = S.chronological_split(df, "id", 0.8).where("split = 'train'")
    assert split.count() == 800_000 and split.agg(F.max("id")).first()[0] == 799_999


def test_global_rank_with_nulls_and_few_rows(spark):
    df = spark.createDataFrame([(None, None, 1), (None, 2.0, 2), ("a", None, 3), ("a", float("nan"), 4), ("a", 1.0, 5)], "g string, x double, id int")
    got = {r.id: r.rank for r in S.global_rank(df, ["x", "id"], groups=["g"], partitions=3).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 5: 2, 4: 3}
    assert S.global_rank(df.limit(0), ["x", "id"]).count() == 0


def test_price_level_missing_rate_propagates(spark):
    df = spark.createDataFrame([(2021, 1.0), (2022, None), (2023, 5.0)], "year int, rate double")
    got = [r.price_level for r in S.price_level(df, "rate", "year", 2021).orderBy("year").collect()]
    assert got == [1.0, None, None]


def test_distributed_lag_and_running_max_match_windows(spark):
    rnd = random.Random(1)
    rows = [(i, float(rnd.randint(0, 50)) if rnd.random() > 0.1 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "t long, v double")
    a = {r.t: (r.v_lag1, r.v_lag3) for r in S.lag_features(df, {"v": [1, 3]}, "t", drop_incomplete=False).collect()}
    b = {r.t: (r.v_lag1, r.v_lag3) for r in S.lag_features(df, {"v": [1, 3]}, "t", drop_incomplete=False,
                                                           distributed=True).collect()}
    assert a == b
    m1 = {r.t: r.v_running_max for r in S.running_max(df, "v", "t").collect()}
    m2 = {r.t: r.v_running_max for r in S.running_max(df, "v", "t", distributed=True).collect()}
    assert m1 == m2
    g = df.withColumn("k", F.col("t") % 3)
    k1 = {r.t: r.v_running_max for r in S.running_max(g, "v", "t", keys=["k"]).collect()}
    k2 = {r.t: r.v_running_max for r in S.running_max(g, "v", "t", keys=["k"], distributed=True).collect()}
    assert k1 == k2


def test_salted_latest_n_matches(spark):
    rnd = random.Random(4)
    rows = [(0 if i % 3 == 0 else rnd.randint(1, 20), i, rnd.random()) for i in range(900)]  # key 0 holds a third
    df = spark.createDataFrame(rows, "k int, t long, v double")
    a = sorted(map(tuple, S.latest_n(df, "t", 5, keys=["k"]).collect()))
    b = sorted(map(tuple, S.latest_n(df, "t", 5, keys=["k"], salt=8).collect()))
    assert a == b and sum(1 for r in a if r[0] == 0) == 5


def test_distributed_keyed_split(spark):
    rows = [(k, t) for k in range(3) for t in range(k * 7 + 3)]
    df = spark.createDataFrame(rows, "k int, t int")
    a = {(r.k, r.t): r.split for r in S.chronological_split(df, "t", 0.7, keys=["k"]).collect()}
    b = {(r.k, r.t): r.split for r in S.chronological_split(df, "t", 0.7, keys=["k"], distributed=True).collect()}
    assert a == b


def test_distributed_keyed_lags(spark, panel):
    a = {(r.k, r.t): (r.v_lag1, r.v_lag3) for r in S.lag_features(panel, {"v": [1, 3]}, "t", keys=["k"], drop_incomplete=False).collect()}
    b = {(r.k, r.t): (r.v_lag1, r.v_lag3) for r in S.lag_features(panel, {"v": [1, 3]}, "t", keys=["k"], drop_incomplete=False,
                                                                  distributed=True).collect()}
    assert a == b


def test_distributed_lags_across_short_ranges(spark):
    """More ranges than rows of a key, ranges with a single row, ties, a hot key
    and null values: as the window over the same order."""
    rnd = random.Random(9)
    rows = [("hot" if i % 3 else rnd.choice([None, "a", "b", f"k{i}"]), rnd.randint(0, 60), rnd.choice([None, rnd.random()]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, v double, id int")
    lags = {"v": [1, 2, 7], "id": [3]}
    names = [f"{c}_lag{n}" for c, ns in lags.items() for n in ns]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    try:
        for keys in (["k"], []):
            out = S.lag_features(df, lags, "t", keys=keys, drop_incomplete=False, distributed=True)
            assert out.columns == [*df.columns, *names]
            w = Window.partitionBy(*keys, F.lit(0)).orderBy("t", F.xxhash64("k", "t", "v", "id"))
            want = df.withColumns({f"{c}_lag{n}": F.lag(c, n).over(w) for c, ns in lags.items() for n in ns})
            assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
            joins = plan_text(out).split("== Initial Plan ==")[0].count("Join")
            assert joins == 1  # the rows before a range, whatever the number of lags
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert S.lag_features(df.limit(0), lags, "t", keys=["k"], distributed=True).count() == 0
    with pytest.raises(ValueError):
        S.lag_features(df, {"v": [0]}, "t", distributed=True)


def test_attach_small_is_a_plain_join(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 3)
    out = S.attach_small(big, big.groupBy("k").count(), ["k"])
    assert out.count() == 100 and out.where("k = 0").first()["count"] == 34
