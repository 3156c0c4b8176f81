"""Property tests over generated inputs."""

import datetime as dt

import duckdb
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from panelkit.operators import quality as Q
from panelkit.operators import series as S
from panelkit.operators.asof import asof_fill, visible_month

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_kv = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 30), st.one_of(st.none(), st.floats(-50, 50))),
                   min_size=1, max_size=40)


@SETTINGS
@given(rows_kv)
def test_keep_last_is_idempotent(spark, rows):
    df = spark.createDataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(rows)], "k int, t int, seq int, v double")
    once = S.keep_last(df, ["k"], ["t", "seq"])
    twice = S.keep_last(once, ["k"], ["t", "seq"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.count() == len({k for k, _, _ in rows})


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.floats(0.5, 100)), min_size=1, max_size=30))
def test_index100_first_row_is_100(spark, rows):
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(rows)], "k int, t int, v double")
    out = S.index100(df, ["v"], "t", keys=["k"])
    firsts = out.groupBy("k").agg(F.min_by("v_index", "t").alias("f")).collect()
    assert all(abs(r.f - 100.0) < 1e-9 for r in firsts)


@SETTINGS
@given(st.integers(1, 60), st.floats(0.05, 0.95))
def test_split_partitions_rows(spark, n, frac):
    df = spark.range(n).withColumnRenamed("id", "t")
    got = {r.split: r["count"] for r in S.chronological_split(df, "t", frac).groupBy("split").count().collect()}
    import math
    assert got.get("train", 0) == math.floor(n * frac) and got.get("train", 0) + got.get("test", 0) == n


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(-5, 5)), st.one_of(st.none(), st.booleans())), min_size=1, max_size=40))
def test_structural_plus_accidental_is_total(spark, rows):
    df = spark.createDataFrame(rows, "v double, rule boolean")
    r = Q.missingness(df, ["v"], structural={"v": F.col("rule")}).first()
    assert r.structural + r.accidental == r.total == sum(v is None for v, _ in rows)
    assert r.structural == sum(v is None and bool(b) for v, b in rows)


events = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 24 * 120), st.one_of(st.none(), st.floats(-9, 9))),
                  min_size=1, max_size=30, unique_by=lambda e: (e[0], e[1]))


@SETTINGS
@given(events)
def test_asof_equals_duckdb_asof_join(spark, evs):
    base = dt.datetime(2021, 1, 1)
    rows = [(k, base + dt.timedelta(hours=h), i, v) for i, (k, h, v) in enumerate(evs)]
    ev = spark.createDataFrame(rows, "k string, ts timestamp_ntz, seq int, v double")
    months = [dt.date(2020, 12, 1)] + [dt.date(2021, m, 1) for m in range(1, 7)]
    spine_rows = [(k, m) for k in "ab" for m in months]
    spine = spark.createDataFrame(spine_rows, "k string, month date")
    got = {(r.k, r.month): (r.v, r.seq) for r in asof_fill(
        spine, ev, keys=["k"], period="month", visible_period=visible_month("ts"),
        event_order=["ts", "seq"], values=["v", "seq"]).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE e (k VARCHAR, ts TIMESTAMP, seq INTEGER, v DOUBLE)")
    con.executemany("INSERT INTO e VALUES (?, ?, ?, ?)", rows)
    con.execute("CREATE TABLE s (k VARCHAR, month DATE)")
    con.executemany("INSERT INTO s VALUES (?, ?)", spine_rows)
    want = {(k, m): (v, q) for k, m, v, q in con.execute(
        "SELECT s.k, s.month, e.v, e.seq FROM s ASOF LEFT JOIN e ON s.k = e.k AND CAST(last_day(s.month) AS TIMESTAMP) >= e.ts"
    ).fetchall()}
    assert got == want
