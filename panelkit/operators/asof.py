"""JN-3: as-of alignment of an event table to a period spine.

Spark has no public as-of join; a ``event_time <= period_end`` join plans as
a nested loop over all pairs. Instead each event is bucketed into the period
in which it first becomes visible, reduced to one row per (key, period) with
``max_by`` (partial aggregation: a hot key costs one row per map task), and
the last visible value is carried forward with a window over the period
grain (keys x periods rows).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def asof_fill(spine: DataFrame, events: DataFrame, *, keys: Sequence[str], period: str,
              visible_period: Column, event_order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Backward as-of: for each spine row (keys, period) the values of the
    last event (by ``event_order``, which must include a tie-breaker) whose
    ``visible_period`` <= period. A NULL value at that event is kept, not
    skipped; periods before the first event get NULL.

    ``spine`` must hold ``keys`` and ``period`` (other columns pass through).
    """
    keys = list(keys)
    bucketed = (events.withColumn(period, visible_period)
                      .groupBy(*keys, period)
                      .agg(F.max_by(F.struct(*[F.col(v) for v in values]),
                                    F.struct(*[F.col(o) for o in event_order])).alias("_ev")))
    # spine rows and event rows side by side: one window carries the last
    # event of an equal or earlier period forward, without a join
    both = spine.withColumn("_event", F.lit(False)).unionByName(bucketed.withColumn("_event", F.lit(True)), allowMissingColumns=True)
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))) \
        .orderBy(period).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    filled = both.withColumn("_ev", F.last("_ev", ignorenulls=True).over(w)).where(~F.col("_event"))
    return filled.select(*spine.columns, *[F.col(f"_ev.{v}").alias(v) for v in values])


def visible_month(ts) -> Column:
    """First month whose month end (midnight of its last day) is >= ts."""
    t = F.col(ts) if isinstance(ts, str) else ts
    m = F.trunc(F.to_date(t), "month")
    late = t.cast("timestamp_ntz") > F.last_day(t).cast("timestamp_ntz")
    return F.when(late, F.add_months(m, 1)).otherwise(m)
