import datetime as dt
import random

from pyspark.sql import functions as F

from panelkit.operators.asof import asof_fill, visible_month
from tests.conftest import plan_text


def _brute(spine, events):
    out = {}
    for k, m in spine:
        end = dt.datetime(m.year, m.month, 1) + dt.timedelta(days=32)
        month_end = dt.datetime(end.year, end.month, 1) - dt.timedelta(days=1)
        cands = [e for e in events if e[0] == k and e[1] <= month_end]
        best = max(cands, key=lambda e: (e[1], e[2])) if cands else None
        out[(k, m)] = best[3] if best else "NONE"
    return out


def test_asof_month_end_matches_brute_force(spark):
    rnd = random.Random(11)
    events = []
    for i in range(400):
        k = rnd.choice("ab")
        ts = dt.datetime(2021, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 200))
        if rnd.random() < 0.1:
            ts = ts.replace(hour=0, minute=0)
        v = None if rnd.random() < 0.1 else round(rnd.random(), 3)
        events.append((k, ts, i, v))
    # an event on the last day after midnight belongs to the next month
    events.append(("a", dt.datetime(2021, 3, 31, 0, 0, 1), 10_000, 9.0))
    ev = spark.createDataFrame(events, "k string, ts timestamp_ntz, seq int, v double")
    months = [dt.date(2020, 12, 1)] + [dt.date(2021, m, 1) for m in range(1, 9)]
    spine_rows = [(k, m) for k in "abc" for m in months]
    spine = spark.createDataFrame(spine_rows, "k string, month date")
    out = asof_fill(spine, ev, keys=["k"], period="month", visible_period=visible_month("ts"),
                    event_order=["ts", "seq"], values=["v", "seq"])
    got = {(r.k, r.month): (r.v if r.seq is not None else "NONE") for r in out.collect()}
    assert got == _brute(spine_rows, events)
    assert "BroadcastNestedLoopJoin" not in plan_text(out)
    assert "CartesianProduct" not in plan_text(out)


def test_asof_keeps_null_valued_event(spark):
    ev = spark.createDataFrame([("a", dt.datetime(2021, 1, 5), 1, 2.0), ("a", dt.datetime(2021, 2, 5), 2, None)],
                               "k string, ts timestamp_ntz, seq int, v double")
    spine = spark.createDataFrame([("a", dt.date(2021, 2, 1)), ("a", dt.date(2021, 3, 1))], "k string, month date")
    out = {r.month: (r.v, r.seq) for r in asof_fill(spine, ev, keys=["k"], period="month", visible_period=visible_month("ts"),
                                                    event_order=["ts", "seq"], values=["v", "seq"]).collect()}
    assert out == {dt.date(2021, 2, 1): (None, 2), dt.date(2021, 3, 1): (None, 2)}
