"""SRT-*: ordering, top-k and previews. Sorting is a sink concern: the
operators here are meant for the end of a plan (or for top-k, which Spark
plans as TakeOrderedAndProject: a per-partition top-k, then a merge of
k rows per partition)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _asc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def sort_time(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SRT-1: ascending, missing last (pandas order)."""
    return df.orderBy(*[_asc(c) for c in cols])


def sort_by_derived(df: DataFrame, exprs: Sequence[Column]) -> DataFrame:
    """SRT-2: order by computed keys without keeping them as columns."""
    return df.orderBy(*[e.asc_nulls_last() for e in exprs])


def top_desc(df: DataFrame, col: str, n: int, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """SRT-3: the n largest rows (ties broken explicitly, so the set is
    deterministic)."""
    return df.orderBy(F.col(col).desc_nulls_last(), *[_asc(t) for t in tie_breakers]).limit(n)


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """SRT-4: preview rows (no order implied)."""
    return df.limit(n)
