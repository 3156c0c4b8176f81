"""Quality rules with adaptive thresholds, in DataFrame functions.

Every document gets word, symbol, line and repetition measures. Their ratios go
into quantile sketches per (language, source): counts of logarithmic bins of
relative width GAMMA, so a sketch is a set of (bin, count) rows, merging is
adding counts, and the result does not depend on order or partitioning. A group
of under ``min_group`` documents takes the merged sketch of its language, and
that of all documents if the language is small too.

A ratio is rejected outside the fence q75 + FENCE * spread (word length also
below q25 - FENCE * spread), where spread is the group's interquartile range, or
the ratio's least spread if the group is more uniform than that. The thresholds
are joined back and applied to each row. Hot (language, source) pairs are joined
by a broadcast of bounded size, the rest by a shuffle (``hot_cold_join``).

Defined results: null and empty texts have no words and fail the base rule; null
languages and sources are groups of their own; null ids, repeated rows and
further columns are carried as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.llm.common import SPACE, hot_cold_join, words
from panelkit.session import cut_lineage

# Fixed values of the base rule.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

GAMMA = 1.02  # ratio of neighbouring bin limits: about 1 % relative error
FENCE = 6.0
#: ratio -> least spread
RATIOS = {"word_length": 0.25, "symbols": 0.01, "dup_lines": 0.1, "repeats": 0.03}
#: The mean word length of n words varies by about this / sqrt(n) in itself.
WORD_LENGTH_SLACK = 6.0
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def measure(df: DataFrame, text: Column) -> DataFrame:
    """df plus MEASURES of ``text`` (long). df's columns must not start with
    an underscore or be named like a measure."""
    keep = df.columns
    t = df.select("*", F.coalesce(text, F.lit("")).alias("_t")).select("*", words(F.col("_t")).alias("_w"))
    t = t.select("*", F.filter(F.split("_t", "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("_l"),
                 F.when(F.size("_w") >= WINDOW,
                        # element by element: slice() would copy the whole array for every window
                        F.transform(F.sequence(F.lit(0), F.size("_w") - WINDOW), lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(WINDOW)])))
                 .otherwise(F.array().cast("array<bigint>")).alias("_h"))
    # windows in order of their hash: equal ones become neighbours. Most texts repeat nothing and skip this.
    sortable = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    t = t.select(*keep, F.size("_w").cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                 (F.length("_t") - F.length(F.regexp_replace("_t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
                 F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                 F.when(F.size(F.array_distinct("_h")) < F.size("_h"), sortable).alias("_s"))
    repeated = F.filter("_s", lambda x, i: F.coalesce(x.h == F.get("_s", i - 1).h, F.lit(False)) | F.coalesce(x.h == F.get("_s", i + 1).h, F.lit(False)))
    t = t.select("*", F.sort_array(F.transform(repeated, lambda x: x.i)).alias("_p"))
    # words under the repeated windows: each adds those before the next one starts
    cover = F.transform("_p", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", i + 1) - p, F.lit(WINDOW))))
    total = F.aggregate(cover, F.lit(0), lambda a, x: a + x)
    return t.select(*keep, *MEASURES[:-1], F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def ratio(name: str) -> Column:
    over, under = {"word_length": ("word_chars", "n_words"), "symbols": ("n_symbols", "word_chars"),
                   "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words")}[name]
    return F.try_divide(F.col(over).cast("double"), F.col(under).cast("double"))


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, ratio, bin, n): one sketch per group and ratio; values of
    zero are in the lowest bin, which is null."""
    r = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), ratio(k).alias("x")) for k in RATIOS])).alias("r")
    bins = F.when(F.col("r.x") > 0, F.ceil(F.ln(F.col("r.x")) / F.lit(math.log(GAMMA))).cast("int"))
    return (measured.filter("n_words > 0").select("lang", "source", r)
            .groupBy("lang", "source", F.col("r.ratio").alias("ratio"), bins.alias("bin")).agg(F.count(F.lit(1)).alias("n")))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles and size of each merged sketch: keys, ratio, q25, q75, size."""
    merged = sketch.groupBy(*keys, "ratio", "bin").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys, "ratio")
    upto = whole.orderBy(F.col("bin").asc_nulls_first())
    c = merged.select("*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("size"))
    value = F.coalesce(F.pow(F.lit(GAMMA), F.col("bin")) * F.lit(2 / (GAMMA + 1)), F.lit(0.0))
    return c.groupBy(*keys, "ratio").agg(
        F.min(F.when(F.col("upto") >= 0.25 * F.col("size"), value)).alias("q25"),
        F.min(F.when(F.col("upto") >= 0.75 * F.col("size"), value)).alias("q75"), F.first("size").alias("size"))


def thresholds(sketch: DataFrame, min_group: int) -> DataFrame:
    """One row per (lang, source): group_size, and lo_ / hi_ of each ratio."""
    own, lang, every = (quartiles(sketch, k) for k in (["lang", "source"], ["lang"], []))
    j = (own.alias("o").join(lang.alias("g"), F.col("o.lang").eqNullSafe(F.col("g.lang")) & (F.col("o.ratio") == F.col("g.ratio")))
         .join(F.broadcast(every).alias("e"), F.col("o.ratio") == F.col("e.ratio")))  # one row per ratio
    pick = lambda c: (F.when(F.col("o.size") >= min_group, F.col(f"o.{c}"))
                      .when(F.col("g.size") >= min_group, F.col(f"g.{c}")).otherwise(F.col(f"e.{c}")))
    j = j.select("o.lang", "o.source", "o.ratio", F.col("o.size").alias("size"), pick("q25").alias("q25"), pick("q75").alias("q75"))
    least = F.coalesce(*[F.when(F.col("ratio") == k, F.lit(v)) for k, v in RATIOS.items()])
    spread = F.greatest(F.col("q75") - F.col("q25"), least)
    fences = j.select("lang", "source", "ratio", "size", (F.col("q25") - FENCE * spread).alias("lo"), (F.col("q75") + FENCE * spread).alias("hi"))
    own_of = lambda k, c: F.max(F.when(F.col("ratio") == k, F.col(c))).alias(f"{c}_{k}")
    return fences.groupBy("lang", "source").agg(F.max("size").alias("group_size"), *[own_of(k, c) for k in RATIOS for c in ("lo", "hi")])


def verdict() -> Column:
    """kept, for rows with measures and thresholds."""
    slack = F.lit(WORD_LENGTH_SLACK) / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    inside = (ratio("word_length") >= F.col("lo_word_length") - slack) & (ratio("word_length") <= F.col("hi_word_length") + slack)
    for k in ("symbols", "dup_lines", "repeats"):
        inside = inside & (ratio(k) <= F.col(f"hi_{k}"))
    return ~base_failed() & F.coalesce(inside, F.lit(False))


def _named(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`").alias(k) for k, c in names.items()])


def judge(docs: DataFrame, min_group: int = 200, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per document: id, measures, base_failed, kept. Measures are written
    once, without the texts, and read for both the sketches and the verdict."""
    d = _named(docs, {"doc_id": id_col, "lang": lang_col, "source": source_col, "_text": text_col})
    m = measure(d.select("doc_id", "lang", "source", F.col("_text").alias("text")), F.col("text")).drop("text")
    m = cut_lineage(m)
    limits = cut_lineage(thresholds(cut_lineage(sketches(m)), min_group))
    with_words = m.filter("n_words > 0")
    joined = hot_cold_join(with_words, limits, ["lang", "source"], "group_size", with_words.count())
    cols = ["doc_id", *MEASURES]
    out = joined.select(*cols, base_failed().alias("base_failed"), verdict().alias("kept"))
    none = m.filter("n_words = 0").select(*cols, F.lit(True).alias("base_failed"), F.lit(False).alias("kept"))
    return out.unionByName(none).withColumnRenamed("doc_id", id_col)


def keep_good(docs: DataFrame, min_group: int = 200, text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source") -> DataFrame:
    """docs that pass, all columns kept. Rows are measured again beside their
    thresholds rather than matched by id, so texts of hot groups (all groups,
    unless there are very many) never shuffle."""
    d = _named(docs, {"lang": lang_col, "source": source_col, "text": text_col})
    limits = cut_lineage(thresholds(cut_lineage(sketches(measure(d, F.col("text")))), min_group))
    n = limits.agg(F.sum("group_size")).first()[0] or 0
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{source_col}`").alias("source"))
    joined = hot_cold_join(rows, limits, ["lang", "source"], "group_size", n)
    judged = measure(joined, F.col(f"row.`{text_col}`"))
    # a filter is pushed below deterministic columns by copying their expressions into it, and the
    # measures would then be computed anew for every element they look up: the row number stops that
    judged = judged.select("row", verdict().alias("pass"), F.monotonically_increasing_id().alias("fence"))
    return judged.filter(F.col("pass") & (F.col("fence") >= 0)).select("row.*")
