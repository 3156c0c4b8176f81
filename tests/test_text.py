import random

from pyspark.sql import functions as F

from panelkit.operators import textscore as TX
from panelkit.sources import web as WB
from tests.conftest import plan_text

LEX = [("rent", 1.0, "worsening"), ("rise", 0.5, "worsening"), ("cut", 1.0, "relief")]


def test_lexicon_substring_semantics(spark):
    df = spark.createDataFrame([(1, "Current RENT rise"), (2, "rate cut"), (3, None), (4, "rentrent")], "id int, t string")
    out = {r.id: r for r in TX.lexicon_score(df, "t", LEX).collect()}
    # 'rent' hits inside 'current', counted once; 'rise' adds its weight
    assert out[1].W == 1.5 and out[1].worsening_hits == 2 and out[1].label == "worsening"
    assert out[2].R == 1.0 and out[2].score == -0.5 and out[2].label == "relief"
    assert out[3].W == 0.0 and out[3].label == "neutral"
    assert out[4].W == 1.0  # occurrences are not counted
    assert abs(out[1].worsening + out[1].relief + 1 / (1.5 + 0 + 1) - 1) < 1e-12


def test_lexicon_stays_a_projection(spark):
    df = spark.range(10).withColumn("t", F.lit("rent"))
    plan = plan_text(TX.lexicon_score(df, "t", LEX))
    assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan


def test_large_lexicon_path(spark):
    lex = [(f"zz{i}", 1.0, "worsening") for i in range(300)] + [("rent", 2.0, "worsening")]
    r = TX.lexicon_score(spark.createDataFrame([("current",)], "t string"), "t", lex).first()
    assert r.W == 2.0 and r.worsening_hits == 1


def test_threshold_labels_and_panel(spark):
    df = spark.createDataFrame([("2024-01", "a", 0.05), ("2024-01", "a", -0.2), ("2024-02", "a", 0.0), (None, "a", 0.9)],
                               "m string, term string, compound double")
    lab = TX.label_by_threshold(df, "compound").withColumn("label", F.col("label"))
    got = [r.label for r in lab.collect()]
    assert got == ["positive", "negative", "neutral", "positive"]
    panel = TX.monthly_text_panel(lab.withColumn("score", F.col("compound")), F.col("m"), ["term"], scores=["score"],
                                  labels=["positive", "negative", "neutral"])
    rows = {r.month: r for r in panel.collect()}
    assert set(rows) == {"2024-01", "2024-02"} and rows["2024-01"].positive_count == 1 and rows["2024-01"].n_docs == 2


def test_clean_corpus_keeps_first(spark):
    df = spark.createDataFrame([(3, "same", "2024-01-02"), (1, "same", "2024-01-01T10:00"), (2, "  ", "x"), (4, "other", "bad")],
                               "id int, t string, d string")
    out = {r.id: r.d for r in TX.clean_corpus(df, "t", ["id"], date="d").collect()}
    assert out == {1: "2024-01-01", 4: None}


def _brute_hits(docs, phrases):
    return {d: sum(1 for _, p in phrases if p and p in t) for d, t in docs}


def test_phrase_audit_matches_brute_force(spark):
    rnd = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa"]
    phrases = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(4, 9))) + ".") for i in range(15)]
    phrases += [(100, "xbeta gamma"), (101, "ta gamma delta eps"), (102, ""), (103, "ta gamma de"), (104, "eta")]  # short / partial-token edges
    docs = []
    for d in range(60):
        parts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(3, 30)))]
        for _ in range(rnd.randint(0, 2)):
            parts.append(rnd.choice(phrases)[1])
        glue = rnd.choice([" ", ", ", "x"])  # 'x' glues a passage mid-token
        docs.append((d, glue.join(parts)))
    docs.append((999, "   "))
    dd = spark.createDataFrame(docs, "doc_id long, text string")
    pp = spark.createDataFrame(phrases, "item_id long, text string")
    got = {r.doc_id: (r.hit_count, r.passes) for r in WB.phrase_audit(dd, pp).collect()}
    want = _brute_hits(docs, phrases)
    assert {k: v[0] for k, v in got.items()} == want
    assert got[999][1] is False and all(v[1] == (v[0] == 0) for k, v in got.items() if k != 999)


def test_extract_links_order_and_fallback(spark):
    html = '<a href="/b">x</a><a href="/a?x=1&amp;y=2">y</a><a href="/b">again</a>'
    df = spark.createDataFrame([(1, html), (2, '<img src="/i.png">'), (3, "none")], "page_id long, html string")
    out = [(r.page_id, r.pos, r.link, r.rule) for r in
           WB.extract_links(df, "html", r'href="([^"]+)"', r'src="([^"]+)"').orderBy("page_id", "pos").collect()]
    assert out == [(1, 1, "/b", "primary"), (1, 2, "/a?x=1&y=2", "primary"), (2, 1, "/i.png", "fallback")]


def test_payload_kind(spark):
    df = spark.createDataFrame([("<!DOCTYPE HTML><p>",), ("PK\x03\x04...",), ("a,b\n1,2",), ("plain",)], "p string")
    assert [r.kind for r in WB.payload_kind(df, "p").collect()] == ["html", "excel", "delimited", "other"]
    b = spark.createDataFrame([(bytes.fromhex("D0CF11E0A1B11AE1") + b"rest",)], "p binary")
    assert WB.payload_kind(b, "p").first().kind == "excel"


def test_latest_snapshot(spark):
    files = [("inflation_20260101.csv",), ("inflation_20260414.xlsx",), ("inflation_20260414.csv",), ("other_20250101.csv",)]
    df = spark.createDataFrame(files, "name string")
    stamp = F.regexp_extract("name", r"_(\d{8})\.", 1)
    ext = F.when(F.col("name").endswith(".csv"), 2).otherwise(1)
    out = {r.dataset: r.name for r in WB.latest_snapshot(df, "name", F.regexp_extract("name", r"^([a-z]+)_", 1), stamp,
                                                         ext, F.lit(1), ["name"]).collect()}
    assert out == {"inflation": "inflation_20260414.csv", "other": "other_20250101.csv"}


def test_latest_release_files(spark, tmp_dir):
    import os
    for n in ["ons_inflation_20260101.csv", "ons_inflation_20260414.xlsx", "inflation_20260414.csv",
              "ons_inflation_nostamp.csv", "unemployment_20250101.csv"]:
        with open(os.path.join(tmp_dir, n), "w") as f:
            f.write("x")
    cat = WB.file_catalog(spark, tmp_dir)
    out = {r.dataset: r.name for r in WB.latest_release_files(
        cat, {"inflation": ["ons_inflation", "inflation"], "unemployment": ["unemployment"]},
        {".csv": 2, ".xlsx": 1}, {"inflation": "ons_inflation"}).collect()}
    assert out == {"inflation": "ons_inflation_20260414.xlsx", "unemployment": "unemployment_20250101.csv"} or \
        out == {"inflation": "inflation_20260414.csv", "unemployment": "unemployment_20250101.csv"}


def test_score_with_pandas_scorer(spark):
    df = spark.createDataFrame([("good good",), ("bad",), (None,)], "t string")
    out = TX.score_with(df, "t", lambda s: s.str.count("good") - s.str.count("bad"))
    lab = [r.label for r in TX.label_by_threshold(out, "compound").collect()]
    assert lab == ["positive", "negative", "neutral"]


def test_payload_alternative_layouts(spark):
    df = spark.createDataFrame([("Date Changed,Rate\n",), ("DATE,IUDBEDR\n",), ("Date,Index\n",)], "p string")
    out = [r.kind for r in WB.payload_kind(df, "p", alternatives=[["Date Changed", "Rate"], ["DATE", "IUDBEDR"]]).collect()]
    assert out == ["delimited", "delimited", "other"]


def test_phrase_audit_anchor_modes_agree(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat today"), (2, "on the mat the cat sat"), (3, "xthe cat sat on")],
                                 "doc_id long, text string")
    ph = spark.createDataFrame([(1, "the cat sat on the"), (2, "cat sat on the mat"), (3, "mat the cat sat")], "item_id long, text string")
    a = {r.doc_id: r.hit_count for r in WB.phrase_audit(docs, ph).collect()}
    b = {r.doc_id: r.hit_count for r in WB.phrase_audit(docs, ph, anchor="longest").collect()}
    assert a == b == {1: 2, 2: 1, 3: 0}


def test_lexicon_duplicate_phrase_counts_once(spark):
    df = spark.createDataFrame([("rent",)], "t string")
    r = TX.lexicon_score(df, "t", [("rent", 1.0, "worsening"), ("RENT", 2.0, "worsening")]).first()
    assert r.W == 2.0 and r.worsening_hits == 1


def test_clean_corpus_trims_before_it_compares(spark):
    df = spark.createDataFrame([(1, "a", "u"), (2, "a ", "u"), (3, "\ta", "v"), (4, " b", "u")], "id int, t string, url string")
    assert sorted(r.id for r in TX.clean_corpus(df, "t", ["id"]).collect()) == [1, 4]
    both = TX.clean_corpus(df, "t", ["id"], also=["url"]).collect()
    assert sorted((r.id, r.t) for r in both) == [(1, "a"), (3, "a"), (4, "b")]


def test_phrase_in_both_polarities_counts_twice(spark):
    df = spark.createDataFrame([("rates rise",)], "t string")
    r = TX.lexicon_score(df, "t", [("rise", 2.0, TX.WORSENING), ("rise", 1.0, TX.RELIEF)]).first()
    assert (r.W, r.R, r.worsening_hits, r.relief_hits) == (2.0, 1.0, 1, 1)


def test_links_are_unescaped_before_distinct(spark):
    df = spark.createDataFrame([(1, 'href="x?a&amp;b" href="x?a&b" href="y"')], "page_id int, html string")
    got = WB.extract_links(df, "html", 'href="([^"]+)"').collect()
    assert [(r.pos, r.link) for r in sorted(got, key=lambda r: r.pos)] == [(1, "x?a&b"), (2, "y")]


def test_short_phrases_without_nested_loops(spark):
    from tests.conftest import plan_text
    docs = spark.createDataFrame([(1, "the cat, sat"), (2, "concatenate"), (3, ""), (4, None), (5, "ca"), (6, "x😀y")], "doc_id long, text string")
    phrases = spark.createDataFrame([(1, "cat"), (2, "c"), (3, "the cat"), (4, "ten ate"), (5, "😀"), (6, "concatenate")], "item_id long, text string")
    out = WB.phrase_audit(docs, phrases)
    assert {r.doc_id: r.hit_count for r in out.collect()} == {1: 3, 2: 3, 3: 0, 4: 0, 5: 1, 6: 1}
    assert "NestedLoop" not in plan_text(out) and "Cartesian" not in plan_text(out)
