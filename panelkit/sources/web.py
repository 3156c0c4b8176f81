"""SRC-9..11 and FLT-11 re-aimed at tables of pages / files / documents."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.operators.series import attach_small

# Markers and signature of the payload kinds.
HTML_MARKERS = ("<html", "<!doctype html")
OLE_MAGIC_HEX = "D0CF11E0A1B11AE1"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def payload_kind(df: DataFrame, col: str, required_terms: Sequence[str] = (",", "\n"),
                 sample_chars: int = 1000, out: str = "kind",
                 alternatives: Sequence[Sequence[str]] = ()) -> DataFrame:
    """SRC-10: 'html' when the first ``sample_chars`` lower-cased contain an
    HTML marker; 'excel' on a zip or OLE signature; 'delimited' when all
    required terms occur (or all terms of any one of ``alternatives``, e.g.
    two accepted column layouts); else 'other'. Works on text or binary
    columns."""
    c = F.col(col)
    is_bin = df.schema[col].dataType.typeName() == "binary"
    # Latin-1 never fails to decode and keeps the ASCII markers intact
    text = F.decode(c, "ISO-8859-1") if is_bin else c
    head = F.lower(F.substring(text, 1, sample_chars))
    html = F.lit(False)
    for m in HTML_MARKERS:
        html = html | F.contains(head, F.lit(m))
    hexhead = F.hex(F.substring(c, 1, 8) if is_bin else F.encode(F.substring(c, 1, 8), "UTF-8"))  # the signatures have 8 bytes
    excel = F.startswith(hexhead, F.lit("504B")) | F.startswith(hexhead, F.lit(OLE_MAGIC_HEX))
    def all_of(ts):
        cond = F.lit(True)
        for t in ts:
            cond = cond & F.contains(text, F.lit(t))
        return cond

    terms = F.lit(False)
    for ts in ([required_terms] if not alternatives else list(alternatives)):
        terms = terms | all_of(ts)
    return df.withColumn(out, F.when(html, "html").when(excel, "excel").when(terms, "delimited").otherwise("other"))


def extract_links(df: DataFrame, col: str, pattern: str, fallback: str | None = None,
                  keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """SRC-11: links matching ``pattern`` (capture group 1), '&amp;'
    unescaped, then distinct in first-seen order; pages without a match use
    ``fallback``. One row per (page, link) with its 1-based position."""
    def links(p: str) -> Column:
        return F.array_distinct(F.transform(F.regexp_extract_all(F.col(col), F.lit(p), 1), lambda x: F.replace(x, F.lit("&amp;"), F.lit("&"))))

    first = links(pattern)
    if fallback:
        second = links(fallback)
        chosen = F.when(F.size(first) > 0, first).otherwise(second)
        rule = F.when(F.size(first) > 0, "primary").when(F.size(second) > 0, "fallback")
    else:
        chosen, rule = first, F.when(F.size(first) > 0, "primary")
    x = df.select(*keys, rule.alias("rule"), F.posexplode(chosen).alias("pos", "link"))
    return x.select(*keys, (F.col("pos") + 1).alias("pos"), "link", "rule")


def host_of(url) -> Column:
    return F.lower(F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))


def latest_snapshot(df: DataFrame, name: str, dataset: Column, stamp: Column,
                    ext_rank: Column, canonical: Column, payload: Sequence[str]) -> DataFrame:
    """SRC-9: per dataset the newest item by (stamp, extension rank,
    canonical flag, lower-cased name). ``max_by`` partially aggregates, so a
    dataset with very many candidates is still reduced map-side."""
    order = F.struct(stamp.alias("s"), ext_rank.alias("e"), canonical.alias("c"), F.lower(F.col(name)).alias("n"))
    return (df.groupBy(dataset.alias("dataset"))
              .agg(F.max_by(F.struct(*[F.col(p) for p in payload]), order).alias("_r"))
              .select("dataset", "_r.*"))


def file_catalog(spark, path: str, glob: str | None = None) -> DataFrame:
    """A table of landed files (path, name, size, modification time). The
    binary content column is never selected, so files are listed, not read."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path).select("path", "length", "modificationTime")
    return df.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))


def latest_release_files(catalog: DataFrame, prefixes: dict, ext_rank: dict, canonical: dict) -> DataFrame:
    """SRC-9 for release files: dataset = the prefix a name starts with;
    only names carrying an 8-digit stamp just before the extension count;
    newest by (stamp, extension rank, canonical prefix, lower-cased name)."""
    name = F.col("name")
    ds = F.lit(None).cast("string")
    for dataset, pres in reversed(list(prefixes.items())):
        hit = F.lit(False)
        for p in pres:
            hit = hit | F.startswith(name, F.lit(f"{p}_"))
        ds = F.when(hit, F.lit(dataset)).otherwise(ds)
    stamp = F.regexp_extract(name, r"_(\d{8})(?=\.[^.]+$)", 1)
    ext = F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    rank = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ext_rank.items() for x in kv]), ext), F.lit(0))
    canon = F.lit(0)
    for dataset, p in canonical.items():
        canon = F.when((ds == dataset) & F.startswith(name, F.lit(f"{p}_")), 1).otherwise(canon)
    c = catalog.withColumn("_ds", ds).where(F.col("_ds").isNotNull() & (stamp != ""))
    return latest_snapshot(c, "name", F.col("_ds"), stamp, rank, canon, ["path", "name", "length"])


# -------------------------------------------------------- FLT-11 phrase audit
_WORD = r"[\p{L}\p{N}_]+"
SHORT_GRAM = 6


def _tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({_WORD})"), 1)


def phrase_audit(docs: DataFrame, phrases: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 phrase_id: str = "item_id", phrase_text: str = "text",
                 by: str = "doc", anchor: str = "longest") -> DataFrame:
    """FLT-11: per document, how many whole phrases (passages) it contains,
    and ``passes`` = non-empty text containing none; ``by="phrase"`` gives
    per phrase the number of documents containing it.

    Exact containment without comparing every document with every phrase:
    an interior token of a phrase is a whole token wherever the phrase
    occurs, and two consecutive interior tokens are adjacent tokens of the
    document. Each phrase is anchored on one interior token bigram,
    documents emit their distinct token bigrams, an equi-join on the bigram
    hash yields candidate pairs, and ``contains`` on the whole texts
    confirms them (three-token phrases anchor on their middle token the same
    way). ``anchor="longest"`` (default) takes the longest interior
    bigram; ``"rarest"`` picks the bigram contained in the fewest documents
    (an extra counting pass over the document bigrams, restricted to phrase
    bigrams, about 2.5x the cost here) for corpora where phrases are made of
    common words and the longest bigram would pair them with much of the
    corpus. Either way every candidate is verified, so the result is exact.
    Phrases of one or two tokens may be parts of tokens; they are anchored on
    their first characters (up to SHORT_GRAM), which documents with such
    phrases around emit as distinct hashed character n-grams.
    """
    p = phrases.select(F.col(phrase_id).alias("_pid"), F.col(phrase_text).alias("_ptext")) \
               .where(F.coalesce(F.length("_ptext"), F.lit(0)) > 0)
    p = p.withColumn("_tok", _tokens(F.col("_ptext")))
    n = F.size("_tok")
    inner = F.slice("_tok", 2, F.greatest(n - 2, F.lit(0)))  # tokens 2 .. n-1 (1-based)
    m = F.greatest(F.size(inner) - 1, F.lit(0))
    bigrams = F.transform(F.arrays_zip(F.slice(inner, 1, m), F.slice(inner, 2, m)),
                          lambda z: F.struct((F.length(z["0"]) + F.length(z["1"])).alias("len"),
                                             z["0"].alias("a"), z["1"].alias("b")))
    d = docs.select(F.col(doc_id).alias("_did"), F.col(text).alias("_dtext"))
    dt = d.select("_did", _tokens(F.col("_dtext")).alias("_t"))
    k = F.greatest(F.size("_t") - 1, F.lit(0))
    dpairs = dt.select("_did", F.explode(F.array_distinct(F.transform(
        F.arrays_zip(F.slice("_t", 1, k), F.slice("_t", 2, k)),
        lambda z: F.xxhash64(z["0"], z["1"])))).alias("_key"))
    if anchor == "longest":
        anchored = p.where(n >= 4).withColumn("_best", F.array_max(bigrams)) \
                    .select("_pid", "_ptext", F.xxhash64(F.col("_best.a"), F.col("_best.b")).alias("_key"))
    else:
        pb = p.where(n >= 4).select("_pid", F.explode(F.array_distinct(F.transform(
            bigrams, lambda z: F.xxhash64(z["a"], z["b"])))).alias("_key"))
        # document frequency of phrase bigrams only (semi join on the small
        # phrase-bigram set, counted map-side)
        freq = (attach_small(dpairs, pb.select("_key").distinct(), "_key", how="left_semi")
                .groupBy("_key").agg(F.count(F.lit(1)).alias("_df")))
        best = (pb.join(freq, "_key", "left")
                  .groupBy("_pid").agg(F.min_by("_key", F.struct(F.coalesce("_df", F.lit(0)), F.col("_key"))).alias("_key")))
        anchored = best.join(p.select("_pid", "_ptext"), "_pid")
    # anchors and candidate pairs are small next to the corpus: each is
    # written, and broadcast if its bytes allow, so texts stay where they are
    cand = attach_small(dpairs, anchored.select("_pid", "_key"), "_key").select("_did", "_pid").distinct()
    cand = attach_small(cand, anchored.select("_pid", "_ptext"), "_pid")
    hits = attach_small(d, cand, "_did").where(F.contains(F.col("_dtext"), F.col("_ptext"))).select("_did", "_pid")
    # three tokens: the middle one is a whole document token -> equi-join
    three = p.where(n == 3).select("_pid", "_ptext", F.xxhash64(F.element_at("_tok", 2)).alias("_key"))
    if not three.isEmpty():
        dtok = dt.select("_did", F.explode(F.array_distinct(F.transform("_t", lambda x: F.xxhash64(x)))).alias("_key"))
        c3 = attach_small(dtok, three.select("_pid", "_key"), "_key").select("_did", "_pid").distinct()
        c3 = attach_small(c3, three.select("_pid", "_ptext"), "_pid")
        hits = hits.unionByName(attach_small(d, c3, "_did")
                                .where(F.contains(F.col("_dtext"), F.col("_ptext"))).select("_did", "_pid"))
    # one or two tokens: anchored on their first characters
    short = p.where(n < 3).withColumn("_g", F.least(F.length("_ptext"), F.lit(SHORT_GRAM)))
    for g in sorted(r["_g"] for r in short.select("_g").distinct().collect()):  # at most SHORT_GRAM values
        own = short.where(F.col("_g") == g).select("_pid", "_ptext", F.xxhash64(F.substring("_ptext", 1, g)).alias("_key"))
        grams = d.select("_did", F.split("_dtext", "").alias("_c")).select("_did", F.explode(F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.greatest(F.size("_c") - (g - 1), F.lit(1))),
            lambda i: F.xxhash64(F.concat_ws("", *[F.get("_c", i - 1 + k) for k in range(g)]))))).alias("_key"))
        found = attach_small(grams, own.select("_pid", "_key"), "_key").select("_did", "_pid").distinct()
        found = attach_small(found, own.select("_pid", "_ptext"), "_pid")
        hits = hits.unionByName(attach_small(d, found, "_did")
                                .where(F.contains(F.col("_dtext"), F.col("_ptext"))).select("_did", "_pid"))
    hits = hits.distinct()
    if by == "phrase":
        per = hits.groupBy("_pid").agg(F.count(F.lit(1)).alias("doc_count"))
        return phrases.select(F.col(phrase_id).alias("_pid")).join(per, "_pid", "left").select(
            F.col("_pid").alias(phrase_id), F.coalesce("doc_count", F.lit(0)).cast("long").alias("doc_count"))
    counts = hits.groupBy("_did").agg(F.count(F.lit(1)).alias("hit_count"))
    out = d.join(counts, "_did", "left").select(
        F.col("_did").alias(doc_id), F.coalesce("hit_count", F.lit(0)).cast("long").alias("hit_count"),
        ((F.coalesce(F.length(F.trim("_dtext")), F.lit(0)) > 0) & F.coalesce(F.col("hit_count") == 0, F.lit(True)))
        .alias("passes"))
    return out
