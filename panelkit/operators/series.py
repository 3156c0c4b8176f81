"""WIN-*: per-key series operators and distributed ordering primitives.

Windows partition by the panel key over period-grain rows, so one task
holds one key's calendar. Orderings over a whole table or over keys with
very many rows (deciles, quantiles, splits, lags, running aggregates) go
through :func:`global_rank` / :func:`global_running`, which range-partition
the rows (a hot key is spread over several ranges) and add offsets from a
small per-range table. Per-group results are joined back with plain joins:
adaptive execution broadcasts them from their measured bytes.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from panelkit.functions.dates import month_ordinal
from panelkit.session import cut_lineage



def _w(keys: Sequence[str], order) -> Window:
    order = [order] if isinstance(order, (str, Column)) else list(order)
    w = Window.orderBy(*order)
    return w.partitionBy(*keys) if keys else w


def join_on_keys(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null keys match each other, as they do in
    groupings and windows. The keys appear once."""
    named = side.withColumnsRenamed({k: f"_key{i}" for i, k in enumerate(keys)})
    on = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return df.join(named, on, how).drop(*[f"_key{i}" for i in range(len(keys))]) if how not in ("left_semi", "left_anti") else df.join(named, on, how)


def _tied(df: DataFrame) -> DataFrame:
    """df with ``_tie``, a hash of the whole row that orders rows of equal time
    the same way on every run."""
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.typeName() != "variant"]
    return df.withColumn("_tie", F.xxhash64(*hashable))


def lag_features(df: DataFrame, lags: Mapping[str, Sequence[int]], time: str,
                 keys: Sequence[str] = (), drop_incomplete: bool = True, distributed: bool = False) -> DataFrame:
    """WIN-1: row-based ``shift(n)`` per key; rows lacking any lag dropped.

    Period-grain series (keyed or not): ``lag`` over a window. With
    ``distributed`` the window runs inside the ranges of :func:`global_rank`
    (a key with very many rows is split across tasks) and each range is handed
    the last rows before it, as many as the longest lag, so no row is joined
    with another one. Rows of equal time are ordered by a hash of the row."""
    names = [f"{c}_lag{n}" for c, ns in lags.items() for n in ns]
    if distributed:
        out = _carried_lags(_tied(df), lags, [time, "_tie"], keys).select(*df.columns, *names)
    else:
        w = _w(keys, time)
        out = df.withColumns({f"{c}_lag{n}": F.lag(c, n).over(w) for c, ns in lags.items() for n in ns})
    return out.dropna(subset=names) if drop_incomplete else out


def _carried_lags(df: DataFrame, lags: Mapping[str, Sequence[int]], order: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """df plus its lags: a window inside each (range, group), completed for the
    first rows of a range from the last rows of the group's earlier ranges. These
    are at most the longest lag for each range and group."""
    depth = max(n for ns in lags.values() for n in ns)
    if min(n for ns in lags.values() for n in ns) < 1:
        raise ValueError("distributed lags look back: at least 1")
    s, w = _ranged(df, order, keys, None), Window.partitionBy("_pid", "_g").orderBy(*order)
    s = s.withColumns({"_loc": F.row_number().over(w), "_last": F.lead(F.lit(True), depth).over(w).isNull(),
                       **{f"_in_{c}_{n}": F.lag(c, n).over(w) for c, ns in lags.items() for n in ns}})
    values = F.struct("_loc", *[F.col(c).alias(f"v{i}") for i, c in enumerate(lags)])
    tails = s.where("_last").groupBy("_pid", "_g").agg(F.array_sort(F.collect_list(values), lambda a, b: a["_loc"] - b["_loc"]).alias("_tail"))
    earlier = Window.partitionBy("_g").orderBy("_pid").rowsBetween(-depth, -1)  # a listed range has a row at least
    before = tails.select("_pid", "_g", F.flatten(F.collect_list("_tail").over(earlier)).alias("_before"))
    if not keys:
        before = F.broadcast(before)  # one row per range

    def value(i: int, c: str, n: int) -> Column:
        back = F.greatest(F.lit(n) - F.col("_loc") + 1, F.lit(1))  # from the end of the rows before the range
        return F.when(F.col("_loc") > n, F.col(f"_in_{c}_{n}")).otherwise(F.try_element_at("_before", -back)[f"v{i}"])

    return s.join(before, ["_pid", "_g"]).withColumns({f"{c}_lag{n}": value(i, c, n) for i, (c, ns) in enumerate(lags.items()) for n in ns})


def running_max(df: DataFrame, col: str, time: str, keys: Sequence[str] = (), out: str | None = None,
                distributed: bool = False) -> DataFrame:
    """WIN-2: cumulative maximum up to the current row. ``distributed``
    uses :func:`global_running` (range partitions) instead of one window
    per key, for keys (or a whole table) with very many rows."""
    name = out or f"{col}_running_max"
    if distributed:
        return global_running(_tied(df), [time, "_tie"], col, "max", groups=list(keys), out=name).drop(f"{name}_total", "_tie")
    w = _w(keys, time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.max(col).over(w))


def index100(df: DataFrame, cols: Sequence[str], time: str, keys: Sequence[str] = (),
             base_time=None, digits: int | None = None) -> DataFrame:
    """WIN-3: value / base value x 100. Base = the first row of the series
    (a missing first value makes the whole index missing) or the row at
    ``base_time``. The base is taken before any filter the caller applies.
    Keyed bases come from a window over the key's periods, so the input is
    computed once; unkeyed bases enter as scalar subqueries."""
    out = {}
    for c in cols:
        if keys:
            base = (F.min_by(F.col(c), F.col(time)) if base_time is None
                    else F.max(F.when(F.col(time) == F.lit(base_time), F.col(c)))).over(Window.partitionBy(*keys))
        else:
            base = (df.select(F.min_by(F.col(c), F.col(time))) if base_time is None
                    else df.where(F.col(time) == F.lit(base_time)).select(F.max(c))).scalar()
        v = F.try_divide(F.col(c), base) * 100
        out[f"{c}_index"] = F.round(v, digits) if digits is not None else v
    return df.withColumns(out)


def price_level(df: DataFrame, rate: str, year: str, base_year: int, keys: Sequence[str] = (),
                digits: int = 4, out: str = "price_level") -> DataFrame:
    """WIN-4: base year = 1; each later year multiplies by (1 + rate/100).
    The running product stays unrounded; only the stored value is rounded.
    A missing rate after the base year makes that year and every later
    level missing (as a running float product would); Spark's ``product``
    alone would skip it."""
    w = _w(keys, year).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = F.col(year) != base_year
    step = F.when(later, 1 + F.col(rate) / 100).otherwise(F.lit(1.0))
    gaps = F.count_if(later & F.col(rate).isNull()).over(w)
    return (df.where(F.col(year) >= base_year)
              .withColumn(out, F.when(gaps == 0, F.round(F.product(step).over(w), digits))))


def gap_check(df: DataFrame, time: str, keys: Sequence[str] = (), ordinal=month_ordinal,
              step: int = 1) -> DataFrame:
    """WIN-5: rows whose ordinal differs from the previous row's by != step."""
    w = _w(keys, time)
    o = ordinal(F.col(time))
    return (df.withColumn("_ord", o)
              .withColumn("_prev_ord", F.lag("_ord").over(w))
              .withColumn(f"prev_{time}", F.lag(time).over(w))
              .where(F.col("_prev_ord").isNotNull() & ((F.col("_ord") - F.col("_prev_ord")) != step))
              .withColumn("gap", F.col("_ord") - F.col("_prev_ord"))
              .drop("_ord", "_prev_ord"))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WIN-6: one row per key, the last by ``order`` (explicit tie-breakers).

    ``max_by`` partially aggregates before the shuffle, so a hot key costs one
    row per map task, not a sort of all its rows."""
    payload = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*payload), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WIN-7: one row per key, the first by ``order``."""
    payload = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*payload), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first per key (QC-4 / WIN-6 report)."""
    return (df.groupBy(*keys).count().where("count > 1")
              .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicates")))


def latest_n(df: DataFrame, time: str, n: int, keys: Sequence[str] = (), salt: int | None = None,
             tie: Sequence[str] = ()) -> DataFrame:
    """WIN-8: newest n rows per key (ascending output order is a sink concern).

    ``salt=S`` for raw rows where one key may hold a large share of the
    table: phase 1 keeps the newest n inside (key, salt) buckets, so the hot
    key's rows are ranked by S tasks; phase 2 ranks at most S x n rows per
    key. ``tie`` adds tie-breakers (the salt is a hash of them)."""
    order = [F.col(time).desc(), *[F.col(t).desc() for t in tie]]
    if not keys:
        return df.orderBy(*order).limit(n)
    if salt:
        bucket = (F.abs(F.xxhash64(F.col(time), *[F.col(t) for t in tie])) % salt).cast("int")
        salted = df.withColumn("_salt", bucket)
        w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn("_rn", F.row_number().over(w1)).where(F.col("_rn") <= n).drop("_rn", "_salt")
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).where(F.col("_rn") <= n).drop("_rn")


def latest_n_periods(df: DataFrame, period: Column | str, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """WIN-9: all rows of the newest n distinct periods (per key when given).

    Unkeyed, the top-n period list has at most n rows, so broadcasting it
    into a semi join is bounded by construction."""
    p = F.col(period) if isinstance(period, str) else period
    tagged = df.withColumn("_period", p)
    if keys:
        top = (tagged.select(*keys, "_period").distinct()
                     .withColumn("_r", F.row_number().over(_w(keys, F.col("_period").desc())))
                     .where(F.col("_r") <= n).drop("_r"))
        return join_on_keys(tagged, top, [*keys, "_period"], "left_semi").drop("_period")
    top = tagged.select("_period").distinct().orderBy(F.col("_period").desc()).limit(n)
    return tagged.join(F.broadcast(top), "_period", "left_semi").drop("_period")


def chronological_split(df: DataFrame, time: str, fraction: float = 0.8, keys: Sequence[str] = (),
                        out: str = "split", distributed: bool = False) -> DataFrame:
    """WIN-10: first floor(n * fraction) rows by time -> 'train', rest 'test'.

    Keyed: row_number and count per key (one key's periods per task), or
    with ``distributed`` the per-group global rank (range partitions split a
    hot key) plus per-key counts. Unkeyed: the distributed global rank, so
    no single task sorts the table."""
    if keys and distributed:
        ranked = global_rank(_tied(df), [time, "_tie"], rank_col="_rn", groups=list(keys)).drop("_tie")
        n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        ranked = join_on_keys(ranked, n, list(keys))
    elif keys:
        w = _w(keys, time)
        ranked = (df.withColumn("_rn", F.row_number().over(w))
                    .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))))
    else:
        ranked = global_rank(_tied(df), [time, "_tie"], rank_col="_rn").drop("_tie")
        ranked = ranked.withColumn("_n", df.select(F.count(F.lit(1))).scalar())
    cut = F.floor(F.col("_n") * F.lit(fraction))
    return ranked.withColumn(out, F.when(F.col("_rn") <= cut, "train").otherwise("test")).drop("_rn", "_n")


def first_event(df: DataFrame, cond: Column, time: str, keys: Sequence[str] = (), out: str = "first_time"):
    """WIN-11: earliest time at which ``cond`` holds, per key."""
    return df.groupBy(*keys).agg(first_event_agg(cond, time).alias(out))


def first_event_agg(cond: Column, time: str) -> Column:
    """WIN-11 as an aggregate, to sit beside others in one pass."""
    return F.min(F.when(cond, F.col(time)))


def latest_row(df: DataFrame, time: Sequence[str] | str, keys: Sequence[str] = ()) -> DataFrame:
    """WIN-12: newest row per key as columns."""
    order = [time] if isinstance(time, str) else list(time)
    return keep_last(df, keys, order) if keys else (
        df.agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*"))


# ------------------------------------------------------------ global ranking
_SAMPLE_PER_PARTITION = 64


def _limits(df: DataFrame, keys: Sequence[str], partitions: int | None) -> tuple[list, list[int]]:
    """Limits of the ranges, ascending, and the steps of a binary search among
    them, from the largest. They are drawn once from a bounded sample (the rows
    with the smallest key hashes; the keys order the rows totally, so equal keys
    cannot crowd it)."""
    p = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = (df.select(*keys).orderBy(F.xxhash64(*keys), *keys).limit(_SAMPLE_PER_PARTITION * p)
                .orderBy(*keys).collect())
    limits = [sample[len(sample) * i // p] for i in range(1, p)] if sample else []
    limits = [r for i, r in enumerate(limits) if i == 0 or r != limits[i - 1]]
    return limits, [1 << i for i in reversed(range(len(limits).bit_length()))]


def _step(table: Column, key: Column, at: Column, n) -> Column:
    """One step of the search: ``n`` further if that limit is not above the key.
    Structs compare with nulls first, as sorts do."""
    return at + F.when(F.coalesce(F.get(table, at + (n - 1)) <= key, F.lit(False)), n).otherwise(F.lit(0))


def _range_id(df: DataFrame, keys: Sequence[str], partitions: int | None) -> Column:
    """Number of the range a row falls in, as one expression of the row alone.

    There are as many ranges as shuffle partitions. Every read of the rows,
    recomputed or not and with whatever columns, puts a row in the same range. A
    binary search finds it. Over many rows or ranges the same steps as columns
    (:func:`_ranged`) are faster: Spark does not compile lambdas, and an array
    literal of structs is slow to plan."""
    limits, steps = _limits(df, keys, partitions)
    if not limits:
        return F.lit(0)
    types = [df.schema[k].dataType for k in keys]
    table = F.array(*[F.struct(*[F.lit(v).cast(t).alias(k) for v, t, k in zip(r, types, keys)]) for r in limits])
    return F.aggregate(F.array(*[F.lit(n) for n in steps]), F.lit(0), lambda at, n: _step(table, F.struct(*keys), at, n))


def _earlier(per_range: DataFrame, agg, col: str) -> Column:
    """Aggregate of the group's earlier ranges; one row per range and group."""
    return agg(col).over(Window.partitionBy("_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))


def _ranged(df: DataFrame, order: Sequence[str], groups: Sequence[str], partitions: int | None) -> DataFrame:
    """df plus its range (_pid) and group (_g, a struct: null groups match).

    The range is that of :func:`_range_id`, with one column per step of the
    search, which compiles to plain code. The limits are one row read by a scalar
    subquery, so the plan's size does not follow their number. The range is never
    null by its type: no join filters on it, which would search again, below an
    aggregate even for every row."""
    keys = [*groups, *order]
    limits, steps = _limits(df, keys, partitions)
    s = df.withColumns({"_pid": F.lit(0), "_g": F.struct(*groups) if groups else F.lit(0)})
    if not limits:
        return s
    row = StructType([StructField(f"k{i}", df.schema[k].dataType) for i, k in enumerate(keys)])
    table = df.sparkSession.createDataFrame([([tuple(r) for r in limits],)], StructType([StructField("t", ArrayType(row))])).scalar()
    # nullable fields on both sides, so that they are of one type and compared without a cast
    s = s.withColumns({"_limits": table, "_key": F.struct(*[F.nullif(F.col(k), F.lit(None)).alias(f"k{i}") for i, k in enumerate(keys)])})
    for n in steps:
        s = s.withColumn("_pid", _step(F.col("_limits"), F.col("_key"), F.col("_pid"), F.lit(n)))
    return s.drop("_limits", "_key")


def global_rank(df: DataFrame, order: Sequence[str], rank_col: str = "rank",
                partitions: int | None = None, groups: Sequence[str] = ()) -> DataFrame:
    """1-based row number over a total order, optionally restarting per group,
    without funnelling rows into one task.

    1. every row gets the number of its (groups, order) range, a function of
       the row (:func:`_ranged`);
    2. a window inside (range, group) gives the local position, so a hot
       group is spread over its ranges;
    3. rows per (range, group) are counted map-side and turned into offsets,
       joined on the window's own keys, so the rows shuffle once.

    The order must be total (add a unique tie-breaker)."""
    s = _ranged(df, order, groups, partitions)
    s = s.withColumn("_loc", F.row_number().over(Window.partitionBy("_pid", "_g").orderBy(*order)))
    counts = s.groupBy("_pid", "_g").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select("_pid", "_g", F.coalesce(_earlier(counts, F.sum, "_cnt"), F.lit(0)).alias("_off"))
    if not groups:
        offsets = F.broadcast(offsets)  # one row per range
    return (s.join(offsets, ["_pid", "_g"])
             .withColumn(rank_col, (F.col("_off") + F.col("_loc")).cast("long"))
             .select(*df.columns, rank_col))


_RUNNING = {"sum": (F.sum, lambda a, b: a + b, 0), "max": (F.max, F.greatest, None), "min": (F.min, F.least, None)}


def global_running(df: DataFrame, order: Sequence[str], value: str, how: str = "sum", groups: Sequence[str] = (),
                   out: str = "running", partitions: int | None = None) -> DataFrame:
    """Inclusive running sum / max / min of ``value`` over a total order (per
    group), distributed like :func:`global_rank`: the running aggregate inside
    each (range, group), combined with the aggregate of the group's earlier
    ranges. Also returns ``{out}_total``, the group's aggregate."""
    agg, combine, zero = _RUNNING[how]
    s = _ranged(df, order, groups, partitions)
    local = Window.partitionBy("_pid", "_g").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = s.groupBy("_pid", "_g").agg(agg(value).alias("_tot"))
    before = _earlier(totals, agg, "_tot")
    offsets = totals.select("_pid", "_g", (F.coalesce(before, F.lit(zero)) if zero is not None else before).alias("_off"),
                            agg("_tot").over(Window.partitionBy("_g")).alias(f"{out}_total"))
    if not groups:
        offsets = F.broadcast(offsets)  # one row per range
    j = s.withColumn("_local", agg(value).over(local)).join(offsets, ["_pid", "_g"])
    # greatest / least skip nulls; a null sum (only nulls so far) adds nothing
    both = combine(F.col("_off"), F.coalesce("_local", F.lit(zero)) if zero is not None else F.col("_local"))
    return j.withColumn(out, both).select(*df.columns, f"{out}_total", out)


def global_cumsum(df: DataFrame, order: Sequence[str], weight: str, groups: Sequence[str] = (),
                  out: str = "cum", partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``weight`` (see :func:`global_running`)."""
    return global_running(df, order, weight, "sum", groups, out, partitions)


def attach_small(df: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a result that is usually small back onto the rows. It is written
    first (its lineage runs once), so the planner knows its size in bytes and
    broadcasts it only within ``spark.sql.autoBroadcastJoinThreshold``; a
    larger one is joined by a shuffle with adaptive skew splitting."""
    return df.join(cut_lineage(small), on, how)


def ntile(df: DataFrame, order: Sequence[str], n: int, out: str = "tile") -> DataFrame:
    """SQL ``ntile(n) OVER (ORDER BY order)`` without a single-task window."""
    ranked = global_rank(df, order, rank_col="_r")
    ranked = ranked.withColumn("_n", df.select(F.count(F.lit(1))).scalar())  # scalar subquery
    base = F.floor(F.col("_n") / n)
    rem = F.col("_n") % n
    big = rem * (base + 1)
    tile = F.when(F.col("_r") <= big, F.floor((F.col("_r") - 1) / (base + 1)) + 1) \
            .otherwise(rem + F.floor((F.col("_r") - 1 - big) / base) + 1)
    return ranked.withColumn(out, tile.cast("int")).drop("_r", "_n")
