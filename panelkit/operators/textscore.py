"""TXT-*: lexicon scoring and monthly text panels.

Scoring is a projection: each phrase becomes one ``contains`` test inside a
single expression, so it runs in whole-stage codegen with no shuffle and no
Python worker. The lexicon is a parameter table of (phrase, weight,
polarity) rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from panelkit.functions.text import case_label, repair_text
from panelkit.operators.relational import drop_blank
from panelkit.operators.series import keep_first

WORSENING, RELIEF = "worsening", "relief"


#: Phrases scored by one generated expression; longer lists are looked through
#: as an array, which keeps generated methods small.
EXPRESSION_PHRASES = 128


def _weight_sum(text: str, entries: Sequence[tuple[str, float]]) -> Column:
    """struct(w, n): summed weight and number of the phrases in the text."""
    t = F.col(text)
    if len(entries) <= EXPRESSION_PHRASES:
        w, n = F.lit(0.0), F.lit(0)
        for p, weight in entries:
            found = F.contains(t, F.lit(p))
            w = w + F.when(found, F.lit(float(weight))).otherwise(F.lit(0.0))
            n = n + found.cast("int")
        return F.struct(w.alias("w"), n.alias("n"))
    phrases = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(float(w)).alias("w")) for p, w in entries])
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0).alias("n"))
    return F.aggregate(phrases, zero, lambda acc, e: F.when(
        F.contains(t, e["p"]), F.struct((acc["w"] + e["w"]).alias("w"), (acc["n"] + 1).alias("n"))).otherwise(acc))


def lexicon_score(df: DataFrame, text: str, lexicon: Sequence[tuple[str, float, str]],
                  hi: float = 0.10, lo: float = -0.10, repair: bool = True) -> DataFrame:
    """TXT-1 + TXT-2: substring lexicon score.

    Each phrase contained in the repaired, lower-cased text adds its weight
    once (no word boundary, no occurrence count). W = worsening weight,
    R = relief weight, denom = W + R + 1:
    worsening = W/denom, relief = R/denom, score = (W-R)/denom,
    net = (R-W)/denom; label by dead zone (score > hi / < lo).
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    if repair:
        # the replacement chain only runs on texts that contain a lead byte
        # of the mis-decoded sequences
        suspect = F.contains(raw, F.lit("â")) | F.contains(raw, F.lit("Â")) | F.contains(raw, F.lit("Ã"))
        raw = F.when(suspect, repair_text(text)).otherwise(F.trim(raw))
    t = F.lower(raw)
    # one entry per phrase and polarity (a later duplicate replaces an earlier
    # one, as in a phrase -> weight mapping for each polarity)
    worse = {p.lower(): w for p, w, pol in lexicon if pol == WORSENING}
    relief = {p.lower(): w for p, w, pol in lexicon if pol == RELIEF}
    # each step is a column that later steps name more than once, so that the
    # optimiser leaves it one and it is computed once per row
    out = df.withColumn("_lower", t)
    out = out.withColumns({"_worse": _weight_sum("_lower", list(worse.items())), "_relief": _weight_sum("_lower", list(relief.items()))})
    out = out.withColumns({"worsening_hits": F.col("_worse.n"), "relief_hits": F.col("_relief.n"), "W": F.col("_worse.w"), "R": F.col("_relief.w")})
    out = out.drop("_lower", "_worse", "_relief")
    denom = F.col("W") + F.col("R") + 1
    out = out.withColumns({
        "worsening": F.col("W") / denom, "relief": F.col("R") / denom,
        "score": (F.col("W") - F.col("R")) / denom, "net": (F.col("R") - F.col("W")) / denom})
    return out.withColumn("label", case_label("score", hi, lo, WORSENING, RELIEF))


def score_with(df: DataFrame, text: str, scorer: Callable[[pd.Series], pd.Series] | None = None, out: str = "compound",
               load: Callable[[], Callable[[pd.Series], pd.Series]] | None = None) -> DataFrame:
    """TXT-3 input slot: a caller-supplied scorer from texts to numbers, given
    itself or by ``load``, which runs once per task in the worker (it may read a
    model there). It gets whole Arrow batches, missing texts as ''. The native path
    is :func:`lexicon_score`."""
    if (scorer is None) == (load is None):
        raise ValueError("give either a scorer or load")

    @F.pandas_udf("double")
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = load() if load else scorer
        for s in batches:
            yield own(s.fillna("")).astype("float64")

    return df.withColumn(out, _score(F.col(text)))


def label_by_threshold(df: DataFrame, score: str, pos: float = 0.05, neg: float = -0.05,
                       out: str = "label") -> DataFrame:
    """TXT-3: inclusive thresholds on any precomputed compound score."""
    return df.withColumn(out, case_label(score, pos, neg, "positive", "negative", inclusive=True))


def clean_corpus(df: DataFrame, text: str, order: Sequence[str], date: str | None = None,
                 keep_text: bool = True, also: Sequence[str] = ()) -> DataFrame:
    """TXT-4: drop blank texts, trim the text, normalise the date, keep the
    first row per trimmed text (and the ``also`` columns, such as a url).
    Rows are grouped on a 256-bit digest plus length; with
    ``keep_text=False`` the text itself is dropped before the shuffle (score
    first, then de-duplicate), so only digests and small columns move."""
    d = drop_blank(df, text).withColumn(text, F.trim(F.regexp_replace(F.col(text), r"^\s+|\s+$", "")))
    if date:
        from panelkit.functions.dates import iso_date
        d = d.withColumn(date, iso_date(date))
    d = d.withColumns({"_h": F.sha2(F.col(text), 256), "_len": F.length(text)})
    if not keep_text:
        d = d.drop(text)
    return keep_first(d, ["_h", "_len", *also], list(order)).drop("_h", "_len")


def monthly_text_panel(scored: DataFrame, month: Column, keys: Sequence[str],
                       scores: Sequence[str] = ("worsening", "relief", "score", "net"),
                       labels: Sequence[str] = (WORSENING, RELIEF, "neutral"), digits: int = 6) -> DataFrame:
    """TXT-5: per (month, keys) mean scores, row count and label counts in
    one aggregate; rows without a parsable month are dropped."""
    s = scored.withColumn("month", month).where(F.col("month").isNotNull())
    return s.groupBy("month", *keys).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.round(F.avg(c), digits).alias(f"avg_{c}") for c in scores],
        *[F.count_if(F.col("label") == F.lit(v)).alias(f"{v}_count") for v in labels])
