"""Readers with rejects, files in several layouts, published refreshes, observed
logs, node tables and sketches, on small fixtures."""

import os
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelkit.operators import modelling as ML
from panelkit.operators import quality as Q
from panelkit.operators import sketches as SK
from panelkit.sources import releases as RL
from panelkit.sources import sinks as SN
from panelkit.streaming import incremental as INC


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_rejected_records_keep_file_and_text(spark, tmp_dir):
    write(tmp_dir, "a.csv", "id,x\n1,2.5\n2,oops\n3\n")
    write(tmp_dir, "b.csv", "id,x\n4,1.0,9\n5,\n,7\n")
    kept, bad = RL.read_checked(spark, tmp_dir, spark.createDataFrame([], "id long, x double").schema)
    assert sorted((r.id, r.x) for r in kept.collect() if r.id) == [(1, 2.5), (5, None)] and kept.where("id IS NULL").first().x == 7.0
    assert sorted((r.file[-5:], r.record) for r in bad.collect()) == [("a.csv", "2,oops"), ("a.csv", "3"), ("b.csv", "4,1.0,9")]
    assert bad.select("record").count() == 3 and kept.select("id").count() == 3  # judged alike whatever is selected


VARIANTS = [{"Day": "day", "Val": "value"}, {"DATE": "day", "VALUE": "value", "Tag": "tag"}]


def test_layout_is_told_per_file(spark, tmp_dir):
    write(tmp_dir + "/x", "a.csv", "Day,Val\n1,10\n2,20\n")
    write(tmp_dir + "/y", "b.csv", "notes for readers\nTag, VALUE ,DATE\nt,30,3\nDay,Val,\n")
    write(tmp_dir, "c.csv", "When,Val\n9,9\n")
    write(tmp_dir, "d.csv", "Day,Val,More\n4,40,z\n")
    rows, bad = RL.read_variants(spark, tmp_dir, VARIANTS)
    want = [("1", "10", None), ("2", "20", None), ("3", "30", "t"), ("4", "40", None), (None, "Val", "Day")]
    assert sorted(((r.day, r.value, r.tag) for r in rows.collect()), key=repr) == sorted(want, key=repr)
    assert [(r.file[-5:], r.reason) for r in bad.collect()] == [("c.csv", "no accepted header")]
    rows, bad = RL.read_variants(spark, tmp_dir, VARIANTS[:1], columns=2)
    assert sorted(r.day for r in rows.collect() if r.file.endswith("a.csv")) == ["1", "2"]
    assert {r.file[-5:]: r.reason for r in bad.collect()} == {"c.csv": "no accepted header", "d.csv": "unexpected number of columns"}


def test_published_table_changes_at_once(spark, tmp_dir):
    target = tmp_dir + "/t"
    batch = lambda rows: spark.createDataFrame(rows, "k long, part string, v long")
    with pytest.raises(INC.MissingSourceError):
        INC.read_current(spark, target)
    assert INC.publish_batch(batch([(1, "a", 1), (2, "b", 1), (3, None, 1)]), target, ["k"], ["v"], "part") == 1
    before = INC.read_current(spark, target)
    assert sorted(map(tuple, before.select("k", "part", "v").collect()), key=repr) == sorted([(1, "a", 1), (2, "b", 1), (3, None, 1)], key=repr)
    # key 1 moves and leaves its partition empty, key 3 stays in the null partition, an older row of key 2 loses
    INC.publish_batch(batch([(1, "c", 2), (3, None, 5), (2, "b", 0)]), target, ["k"], ["v"], "part")
    now = sorted(map(tuple, INC.read_current(spark, target).select("k", "part", "v").collect()), key=repr)
    assert now == sorted([(1, "c", 2), (2, "b", 1), (3, None, 5)], key=repr)
    old = INC.read_current(spark, target, 1).select("k", "part", "v").collect()
    assert sorted(r.v for r in old) == [1, 1, 1]  # a reader of the first version still sees it
    # a version that was written but not published is not seen, and its number is used again
    batch([(9, "a", 9)]).write.partitionBy("part").parquet(f"{target}/data/version=3")
    assert 9 not in [r.k for r in INC.read_current(spark, target).collect()]
    assert INC.publish_batch(batch([(4, "a", 1)]), target, ["k"], ["v"], "part") == 3
    assert sorted(r.k for r in INC.read_current(spark, target).collect()) == [1, 2, 3, 4]
    same = INC.publish_batch(batch([(4, "a", 1)]), target, ["k"], ["v"], "part")  # a rerun of the batch
    assert same == 4 and INC.read_current(spark, target).count() == 4


def test_log_counts_what_the_cleaning_saw(spark):
    rows = [("Title", "Mean price", 0), ("2020", "1", 1), ("2020 JAN", "1", 2), ("2020 JAN", "2", 3), ("2020 FEB", "x", 4), ("2020 XXX", "3", 5), ("2020 MAR", "4", 6)]
    df = spark.createDataFrame(rows, "_c0 string, _c1 string, line int")
    log = Q.CleanLog("prices")
    out = RL.clean_monthly_release(RL.select_series(df, "price"), n_months=2, log=log).collect()
    assert sorted((r.year_month, r.value) for r in out) == [("2020-02", None), ("2020-03", 4.0)]
    assert log.entry() == {"dataset": "prices", "rows_in": 5, "unparsable": 2, "duplicates": 1, "rows_out": 2, "coverage": "2020-02 to 2020-03"}
    assert [tuple(r) for r in Q.observed_log(spark, [log]).collect()] == [("prices", 5, 2, 1, 2, "2020-02 to 2020-03")]


def test_node_table_scores_like_the_forest(spark, tmp_dir):
    rnd = random.Random(2)
    rows = [(i, rnd.random(), rnd.random(), float(rnd.randint(0, 3))) for i in range(200)]
    df = spark.createDataFrame(rows, "i long, a double, b double, c double").withColumn("y", F.col("a") * 3 + F.col("c"))
    model = ML.fit_forest(df, ["a", "b", "c"], "y", num_trees=7, max_depth=4)
    ML.save_model(model, tmp_dir + "/m")
    nodes = ML.forest_nodes(spark, tmp_dir + "/m")
    assert nodes.select("tree").distinct().count() == 7 and nodes.where("left < 0 AND threshold IS NOT NULL AND feature >= 0").count() == 0
    both = ML.predict(model, ML.score_nodes(nodes, df, ["a", "b", "c"], 4, "own")).collect()
    assert [r.own for r in both] == pytest.approx([r.prediction for r in both])
    imp = {r.feature: r.importance for r in ML.node_importances(nodes, ["a", "b", "c"]).collect()}
    assert imp == pytest.approx({f: v for f, v in zip("abc", model.stages[-1].featureImportances.toArray()) if v})
    with pytest.raises(ValueError, match="fitted on"):
        ML.load_model(tmp_dir + "/m", ["a", "c", "b"])


def test_sketches_merge_and_stay_close(spark):
    rnd = np.random.default_rng(3)
    x = np.concatenate([rnd.lognormal(0, 2, 4000), -rnd.lognormal(0, 1, 500), np.zeros(100)])
    df = spark.createDataFrame([(int(i % 9), float(v)) for i, v in enumerate(x)] + [(1, None), (1, float("nan"))], "p int, v double")
    whole = SK.quantile_sketch(df, "v")
    merged = SK.merge_sketches(SK.quantile_sketch(df, "v", ["p"]))
    assert sorted(map(repr, whole.select("sign", "bin", "n").collect())) == sorted(map(repr, merged.select("sign", "bin", "n").collect()))
    for r in SK.sketch_quantiles(merged, [0.0, 0.05, 0.5, 0.9, 1.0]).collect():
        exact = np.sort(x)[max(int(np.ceil(r.q * len(x))), 1) - 1]
        assert r.n == len(x) and abs(r.estimate - exact) <= 0.0101 * abs(exact)
        rank = (x <= r.estimate + 0.0101 * abs(r.estimate)).mean()
        assert rank >= r.q - 0.01
    ids = spark.range(20_000).select((F.col("id") % 7).alias("p"), (F.col("id") % 5000).alias("u"))
    est = SK.distinct_estimate(SK.merge_distinct(SK.distinct_sketch(ids, "u", ["p"]))).first().estimate
    assert abs(est / 5000 - 1) < 0.065


def test_sorted_files_can_be_skipped(spark, tmp_dir):
    df = spark.range(40_000).select(((F.col("id") * 7919) % 40_000).alias("k"), F.rand(1).alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small files, as if there were many rows
    SN.write_table(df, tmp_dir + "/s", sort_by=["k"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = []
    for name in os.listdir(tmp_dir + "/s"):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(os.path.join(tmp_dir, "s", name)).metadata
            stats = [meta.row_group(g).column(0).statistics for g in range(meta.num_row_groups)]
            spans.append((min(s.min for s in stats), max(s.max for s in stats)))
    spans.sort()
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # a range of keys touches few files
    plan = spark.read.parquet(tmp_dir + "/s").where("k BETWEEN 5 AND 9")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,5)" in plan and "LessThanOrEqual(k,9)" in plan
