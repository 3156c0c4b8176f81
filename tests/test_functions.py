import datetime as dt

from pyspark.sql import functions as F

from panelkit.functions import dates as D
from panelkit.functions import text as X


def _one(spark, expr, rows, schema="s string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_month_label(spark):
    got = _one(spark, D.parse_month_label("s"), [("2023 JAN",), ("2023 jan",), ("2023 Q1",), ("bad",), (None,)])
    assert got == [dt.date(2023, 1, 1), dt.date(2023, 1, 1), None, None, None]


def test_dayfirst_and_two_digit_pivot(spark):
    got = _one(spark, D.parse_dayfirst("s"), [("03/11/2021",), ("04 AUG 75",), ("04 Aug 21",), ("01/Feb/99",),
                                               ("2020-02-29",), ("31/02/2021",), ("x",)])
    assert got == [dt.date(2021, 11, 3), dt.date(1975, 8, 4), dt.date(2021, 8, 4), dt.date(1999, 2, 1),
                   dt.date(2020, 2, 29), None, None]


def test_year_month_strict(spark):
    got = _one(spark, D.parse_year_month("s"), [("2021-03",), ("2021-13",), ("21-03",)])
    assert got == [dt.date(2021, 3, 1), None, None]


def test_month_end_quarter_ordinal(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 10),)], "d date")
    r = df.select(D.month_end("d").alias("e"), D.quarter_label("d").alias("q"), D.month_ordinal("d").alias("o"),
                  D.year_month("d").alias("ym")).first()
    assert r.e == dt.date(2024, 2, 29) and r.q == "2024Q1" and r.o == 2024 * 12 + 2 and r.ym == "2024-02"


def test_fiscal_period(spark):
    rows = [("2017-18",), ("2017/18",), ("2017-2018",), ("2018",), ("1999-00",), ("nonsense",)]
    assert _one(spark, D.fiscal_period_end("s"), rows) == ["2018-03", "2018-03", "2018-03", "2018-03", "2000-03", None]
    assert _one(spark, D.fiscal_period_start("s"), rows) == [2017, 2017, 2017, 2018, 1999, None]


def test_stamp_to_date(spark):
    rows = [("ons_inflation_20260414.csv",), ("ons_20260414_final.csv",), ("no_stamp.csv",)]
    assert _one(spark, D.stamp_to_date("s", strict=True), rows) == [dt.date(2026, 4, 14), None, None]
    loose = _one(spark, D.stamp_to_date("s", default=F.lit(dt.date(2000, 1, 1))), rows)
    assert loose == [dt.date(2026, 4, 14), dt.date(2026, 4, 14), dt.date(2000, 1, 1)]


def test_iso_date(spark):
    assert _one(spark, D.iso_date("s"), [("2024-03-05T10:00:00Z",), ("2024-03-05",), ("junk",)]) == \
        ["2024-03-05", "2024-03-05", None]


def test_repair_and_labels(spark):
    assert _one(spark, X.repair_text("s"), [("  Itâ€™s  ",), (None,)]) == ["It's", ""]
    df = spark.createDataFrame([(0.2,), (-0.2,), (0.1,), (0.05,), (None,)], "v double")
    dead = [r[0] for r in df.select(X.case_label("v", 0.1, -0.1, "up", "down")).collect()]
    incl = [r[0] for r in df.select(X.case_label("v", 0.05, -0.05, "pos", "neg", inclusive=True)).collect()]
    assert dead == ["up", "down", "neutral", "neutral", None]
    assert incl == ["pos", "neg", "pos", "pos", None]


def test_title_label(spark):
    assert _one(spark, X.title_label("s"), [("random_forest",)]) == ["Random Forest"]


def test_parse_dayfirst_layouts(spark):
    want = {"19 Mar 2020": "2020-03-19", "02 March 2020": "2020-03-02", "1/2/2020": "2020-02-01", "01/02/20": "2020-02-01", "01/02/2020": "2020-02-01",
            "2 Mar 99": "1999-03-02", "02-Mar-20": "2020-03-02", "02/MAR/2020": "2020-03-02", "2020-03-19 10:30:00": "2020-03-19",
            "19/03/2020 00:00": "2020-03-19", "2020-03-19T10:30:00Z": "2020-03-19", "31/02/2020": None, "x": None, "13 2020": None}
    df = spark.createDataFrame([(k,) for k in want], "t string")
    got = {r.t: r.d for r in df.select("t", F.date_format(D.parse_dayfirst("t"), "yyyy-MM-dd").alias("d")).collect()}
    assert got == want
