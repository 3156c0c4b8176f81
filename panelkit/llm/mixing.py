"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length in words. A source that should give more
than it has is passed over whole as often as fits; what remains of its target is
fitted from its length counts: an even share of every length first, then a
bounded-knapsack search over lengths and counts for all the words still missing,
however long the documents are. While the nearest possible sum is not reached, the
share leaves more words to the search, up to the whole budget or MAX_WIDTH: what
fits a budget of at most MAX_WIDTH words is always found. Of each length, as many documents are taken as the fit says, in the order of a
seeded hash of their id.

The fit sees one row per source and distinct length. The choice of documents
ranks inside (source, length, hash bucket), so neither a source nor a length that
holds a third of all rows meets in one task.

Defined results: null and empty texts have size 0 and take nothing; a null source
comes last in the order of sources; null ids hash like a fixed id; equal ids and
repeated rows are taken one by one; an empty table gives an empty result; further
columns are carried by ``mix`` and ignored by ``plan_rows``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.llm.common import words
from panelkit.operators.series import global_rank
from panelkit.session import cut_lineage

WEIGHTS = (1, 2, 3)  # of the sources in their order, repeating
MAX_REPEAT = 3
WIDTH = 4096  # words left to the exact search at first
MAX_WIDTH = 1 << 24  # and at most, when narrower searches do not reach the budget
BUCKETS = 1024
KEY = ["skey", "size", "bucket"]


def prepared(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str, carry: list[Column]) -> DataFrame:
    """carry plus skey (the source, never null), size, h, bucket."""
    src = F.col(f"`{source_col}`").cast("string")
    h = F.xxhash64(F.col(f"`{id_col}`"), F.lit(seed))
    d = docs.select(*carry, F.when(src.isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), src)).alias("skey"),
                    F.size(words(F.col(f"`{text_col}`"))).cast("long").alias("size"), h.alias("h"))
    return d.withColumn("bucket", F.pmod("h", F.lit(BUCKETS).cast("long")).cast("int"))


def targets(hist: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(skey, source_size, target): shares of all words by weight; a target
    stops at max_repeat times its source's words and the excess is shared again.

    With a rate of words per weight, a source is full when rate * weight exceeds
    its most. The rate rises until the set of full sources stays the same; each
    round brings three sums to the driver.
    """
    sums = hist.groupBy("skey").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ranked = global_rank(sums, ["skey"], rank_col="_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    s = cut_lineage(ranked.select("skey", "source_size", weight.alias("w"), (max_repeat * F.col("source_size")).cast("double").alias("most")))
    total = float(s.agg(F.sum("source_size")).first()[0] or 0)
    rate, full = None, -1
    while True:
        over = F.lit(False) if rate is None else F.col("w") * rate > F.col("most")
        n, taken, w = s.agg(F.sum(over.cast("int")), F.sum(F.when(over, F.col("most")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("w")))).first()
        if n is None or n == full:
            break
        full = n
        rate = (total - taken) / w if w else rate
    share = F.lit(0.0) if rate is None else F.least(F.col("w") * rate, F.col("most"))
    return s.select("skey", "source_size", share.alias("target"))


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """How many documents of each length to take so that their lengths add up
    to the budget or the nearest sum found. sizes: distinct and positive."""
    sizes, counts = np.asarray(sizes, np.int64), np.asarray(counts, np.int64)
    whole = int((sizes * counts).sum())
    if budget <= 0 or not len(sizes):
        return np.zeros(len(sizes), np.int64)
    if budget >= whole:
        return counts.copy()
    if 2 * budget > whole:  # fit what is left out: then there is always enough to choose from
        return counts - fit_counts(sizes, counts, whole - budget, seed)
    order = np.argsort(sizes, kind="stable")
    s, c = sizes[order], counts[order]
    offset = np.random.default_rng(seed).random()
    unit = int(np.gcd.reduce(s))
    nearest = min(budget % unit, -budget % unit)
    width, share = WIDTH, max(budget - WIDTH, budget // 2)
    best = fit_near(s, c, budget, share, width, offset)
    missed = abs(budget - int((best * s).sum()))
    while missed > nearest and share and width <= MAX_WIDTH:
        share = max(budget - width, 0)
        take = fit_near(s, c, budget, share, width, offset)
        miss = abs(budget - int((take * s).sum()))
        if miss < missed:
            best, missed = take, miss
        width *= 8
    out = np.zeros(len(sizes), np.int64)
    out[order] = best
    return out


def fit_near(s: np.ndarray, c: np.ndarray, budget: int, share: int, width: int, offset: float) -> np.ndarray:
    """An even share of all lengths, and the counts that bring its sum nearest
    to the budget; about ``width`` words are left to that search."""
    # rounded along the running count
    upto = np.floor(np.concatenate([[0], np.cumsum(c)]) * (share / int((s * c).sum())) + offset * (share > 0)).astype(np.int64)
    take = np.clip(np.diff(upto), 0, c)
    rest = budget - int((take * s).sum())
    for i in range(len(s) - 1, -1, -1):  # too many words: give back long documents
        if rest >= 0:
            break
        back = min(int(take[i]), -(rest // int(s[i])))
        take[i] -= back
        rest += back * int(s[i])
    for i in range(len(s) - 1, -1, -1):  # too few by far: add long documents
        if rest > 2 * width:
            more = min(int(c[i] - take[i]), (rest - width) // int(s[i]))
            take[i] += more
            rest -= more * int(s[i])
    return take + knapsack(s, c - take, rest, over=True)


def knapsack(sizes: np.ndarray, free: np.ndarray, budget: int, over: bool = False) -> np.ndarray:
    """Bounded-knapsack search over the whole budget: counts of at most ``free``
    whose sizes reach the largest sum of at most ``budget``, or with ``over`` the
    sum nearest to it. Reachable sums, in units of the sizes' common divisor, are
    the bits of a number; the length that first reached each sum is kept to read
    the counts back."""
    out = np.zeros(len(sizes), np.int64)
    budget = int(budget)
    usable = np.flatnonzero((sizes <= (2 * budget if over else budget)) & (free > 0))
    if budget <= 0 or not len(usable):
        return out
    unit = int(np.gcd.reduce(sizes[usable]))
    low, last = budget // unit, min((2 * budget if over else budget) // unit, int((sizes[usable] * free[usable]).sum()) // unit)
    goal = low + 1 if over and (low + 1) * unit - budget < budget - low * unit else low
    mask, reach = (1 << (last + 1)) - 1, 1
    first = np.full(last + 1, -1, np.int32)  # place in usable; -1: none, or the empty sum
    for j, i in enumerate(usable):
        size, before = int(sizes[i]) // unit, reach
        left, step = min(int(free[i]), last // size), 1
        while left > 0:  # counts in powers of two
            k = min(step, left)
            reach |= (reach << (k * size)) & mask
            left, step = left - k, step * 2
        new = np.frombuffer((reach ^ before).to_bytes(last // 8 + 1, "little"), np.uint8)
        for at in range(0, len(new), 1 << 20):
            part = new[at:at + (1 << 20)]
            if part.any():
                to = first[8 * at:8 * (at + len(part))]
                to[np.unpackbits(part, count=len(to), bitorder="little").view(bool)] = j
        if reach >> goal & 1:
            break
    at = (reach & ((1 << (low + 1)) - 1)).bit_length() - 1
    if over and (above := reach >> (low + 1)):
        upper = low + (above & -above).bit_length()
        at = upper if upper * unit - budget < budget - at * unit else at
    while at:  # the sum without this length's documents was reached by an earlier one
        j = int(first[at])
        i = usable[j]
        while first[at] == j:
            out[i] += 1
            at -= int(sizes[i]) // unit
    return out


def plan(hist: DataFrame, seed: int, weights: tuple[int, ...], max_repeat: int) -> DataFrame:
    """(skey, size, source_size, target, passes, extra): how often every document
    of the length is taken, and how many of them once more."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size")
        whole, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        passes = min(int(target // whole), max_repeat) if whole else 0
        some = (pdf["size"] > 0).to_numpy()
        pdf["extra"] = 0
        if passes < max_repeat:
            pdf.loc[some, "extra"] = fit_counts(pdf["size"].to_numpy()[some], pdf["n"].to_numpy()[some], round(target - passes * whole), seed)
        pdf["passes"] = passes
        return pdf[["skey", "size", "source_size", "target", "passes", "extra"]]

    t = targets(hist, weights, max_repeat)
    return hist.join(t, "skey").groupBy("skey").applyInPandas(
        fit, "skey string, size long, source_size long, target double, passes int, extra long")


def allocate(rows: DataFrame, seed: int = 1, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT,
             counted: DataFrame | None = None) -> DataFrame:
    """prepared rows plus source_size, target and copies (times taken).
    counted: the rows to count from, if cheaper than ``rows``."""
    by_bucket = cut_lineage((rows if counted is None else counted).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")))
    hist = cut_lineage(by_bucket.groupBy("skey", "size").agg(F.sum("n").alias("n")))
    p = cut_lineage(plan(hist, seed, weights, max_repeat))
    before = Window.partitionBy("skey", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = by_bucket.join(p, ["skey", "size"]).select(
        *KEY, "source_size", "target", "passes",
        F.greatest(F.lit(0), F.col("extra") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("quota"))
    rank = F.row_number().over(Window.partitionBy(*KEY).orderBy("h"))
    return rows.withColumn("rank", rank).join(quota, KEY).withColumn(
        "copies", F.col("passes") + (F.col("rank") <= F.col("quota")).cast("int")).drop("rank", "quota", "passes")


def plan_rows(docs: DataFrame, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Per document: id, size, source_size, target, taken, copies."""
    rows = cut_lineage(prepared(docs, seed, id_col, text_col, source_col, [F.col(f"`{id_col}`")]))
    a = allocate(rows, seed, weights, max_repeat)
    return a.select(F.col(f"`{id_col}`"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix(docs: DataFrame, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mixed documents, all columns kept, each as often as it is taken.
    Lengths are counted without the texts; texts then shuffle once, to the
    bucket in which they are ranked."""
    packed = docs.select(F.struct("*").alias("row"), *[F.col(f"`{c}`").alias(k) for k, c in (("_id", id_col), ("_text", text_col), ("_source", source_col))])
    rows = prepared(packed, seed, "_id", "_text", "_source", [F.col("row")])
    counted = prepared(packed, seed, "_id", "_text", "_source", [])
    a = allocate(rows, seed, weights, max_repeat, counted)
    return a.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
