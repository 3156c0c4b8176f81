"""Plan-shape checks: the properties the scale design relies on."""

from pyspark.sql import functions as F

from panelkit.operators import series as S
from panelkit.operators import stats as A
from panelkit.plans import queries as Q
from panelkit.sources import web as WB
from tests.conftest import SF, plan_text


def test_keep_last_aggregates_before_shuffle(spark):
    # one key holds a third of the rows: partial max_by reduces it map-side
    df = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")))
    out = S.keep_last(df.withColumn("v", F.col("id") * 2), ["k"], ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert out.where("k = 0").first().id == 2997


def test_quantiles_pre_aggregate_values(spark):
    df = spark.range(5000).withColumn("v", (F.col("id") % 5).cast("double"))
    plan = plan_text(A.exact_quantiles(df, "v", [0.5]))
    assert "partial_count" in plan
    windows = [line for line in plan.splitlines() if " Window " in line or line.strip().startswith("+- Window") or "- Window [" in line]
    rows = [line for line in windows if "_v#" in line]  # those over the values, not over one row per range
    assert rows and all("_pid#" in line for line in rows)


def test_scan_prunes_columns_and_pushes_filters(spark):
    plan = plan_text(Q.typed_filters(spark, SF))
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double," in plan
    assert "o_orderdate" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan


def test_no_cross_products_in_queries(spark):
    for fn in (Q.phrase_audit, Q.asof_day_end, Q.asof_month_end_status, Q.burden, Q.histogram, Q.reg_metrics):
        plan = plan_text(fn(spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, fn.__name__


def test_text_panel_shuffles_no_text(spark):
    plan = plan_text(Q.text_panel(spark, SF))
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "text" not in line


def test_phrase_audit_brute_force_on_driver_fixture(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {d: sum(1 for _, p in bench if p and p in t) for d, t in docs}
    got = {r.doc_id: r.hit_count for r in WB.phrase_audit(spark.read.parquet(f"{SF}/documents.parquet"),
                                                          spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert got == want
