import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from panelkit.sources import releases as RL
from panelkit.sources import sinks as SK
from panelkit.streaming.incremental import MissingSourceError, refresh


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _release_text(title, months, dup_first=False):
    lines = [f'"Title","{title}"', '"CDID","X1"', '"Source dataset ID","T"', '"PreUnit",""', '"Unit","%"',
             '"Release date","01-01-2024"', '"Next release",""', '"Important notes",', '"2019","1.5"', '"2020 Q1","1.1"']
    if dup_first:
        lines.append('"2020 JAN","0.0"')
    for i, (y, m) in enumerate(months):
        lines.append(f'"{y} {m}","{i / 10:.1f}"')
    lines.append('"2020 FEB","x"')
    return "\n".join(lines) + "\n"


MONTHS = [(2020, m) for m in ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]]


def test_release_pipeline(spark, tmp_dir):
    p = f"{tmp_dir}/rel/rate_20240101.csv"
    _write(p, _release_text("CPIH ANNUAL RATE", MONTHS, dup_first=True))
    raw = RL.read_release(spark, p)
    assert raw.count() == 24
    s = RL.select_series(raw, "annual rate")
    out = RL.clean_monthly_release(s, n_months=6, geo_name="UK").orderBy("year_month").collect()
    assert [r.year_month for r in out] == ["2020-07", "2020-08", "2020-09", "2020-10", "2020-11", "2020-12"]
    assert out[-1].value == 1.1 and out[0].geo_name == "UK"
    full = {r.year_month: r.value for r in RL.clean_monthly_release(s, n_months=60).collect()}
    assert full["2020-01"] == 0.0 and full["2020-02"] is None  # last row in file order wins
    with pytest.raises(RL.SchemaError):
        RL.select_series(raw, "unemployment")


def test_schema_helpers(spark):
    a = spark.createDataFrame([("01/02/2021", "1.5")], "`Date Changed` string, Rate string")
    b = spark.createDataFrame([("02 Mar 21", "2.0")], "DATE string, IUDBEDR string")
    u = RL.unify_variants([a, b], RL.RATE_VARIANTS)
    assert sorted(u.columns) == ["date", "rate"] and u.count() == 2
    with pytest.raises(RL.SchemaError):
        RL.resolve_schema_variant(spark.createDataFrame([(1,)], "x int"), RL.RATE_VARIANTS)
    two = RL.expect_columns(spark.createDataFrame([("a", "b")], "_c0 string, _c1 string"), ["label", "value"])
    assert two.columns == ["label", "value"]
    with pytest.raises(RL.SchemaError):
        RL.expect_columns(two, ["only"])
    n = RL.normalise_headers(spark.createDataFrame([(1,)], "` Decile Group ` int"), ["decile group"])
    assert n.columns == ["decile group"]


def test_month_end_rate(spark):
    ev = spark.createDataFrame([("05/01/2021", "0.1"), ("16 DEC 21", "0.25"), ("31/12/2021", "0.5"), ("bad", "1")],
                               "`Date Changed` string, Rate string")
    spine = spark.createDataFrame([(dt.date(2020, 12, 1),), (dt.date(2021, 1, 1),), (dt.date(2021, 12, 1),),
                                   (dt.date(2022, 1, 1),)], "month date")
    got = {r.year_month: r.rate for r in RL.month_end_rate(ev, spine).collect()}
    assert got == {"2020-12": None, "2021-01": 0.1, "2021-12": 0.5, "2022-01": 0.5}


def test_income_layouts(spark):
    long = spark.createDataFrame([(y, " All ", "Disposable", f"Decile {d}", str(d * 1000 + i))
                                  for i, y in enumerate(["2018-19", "2019-20", "2020-21"]) for d in range(1, 11)]
                                 + [("2020-21", "Retired", "Disposable", "Decile 1", "5")],
                                 "fye string, grp string, comp string, dec string, gbp string")
    l = RL.long_income(long, period="fye", group="grp", component="comp", decile="dec", value="gbp",
                       group_value="all", component_value="disposable", latest=2)
    assert l.count() == 20 and {r.period for r in l.collect()} == {"2019-20", "2020-21"}
    out = RL.income_by_decile(l, 5, income_frequency="annual")
    r = {(x.year_month, x.decile): x.income_value for x in out.collect()}
    assert r[("2021-03", 10)] == 10002.0 and len(r) == 20
    wide = spark.createDataFrame([("x", "2020-21") + tuple(str(d) for d in range(1, 11))],
                                 "_0 string, year string, " + ", ".join(f"d{i} string" for i in range(1, 11)))
    w = RL.wide_income_to_long(wide, "year", [f"d{i}" for i in range(1, 11)])
    assert [(x.decile, x.value) for x in w.orderBy("decile").collect()][:2] == [(1, 1.0), (2, 2.0)]


def test_price_release_layouts(spark):
    v1 = spark.createDataFrame([("01/01/2021", "A", "E1", 100.0, 90.0), ("15/01/2021", "A", "E1", 110.0, 91.0),
                                ("01/02/2021", "B", "E2", 50.0, 40.0)],
                               "Date string, RegionName string, AreaCode string, AveragePrice double, Index double")
    out = {(r.region, r.year_month): r["index"] for r in RL.clean_price_release(v1).collect()}
    assert out == {("A", "2021-01"): 91.0, ("B", "2021-02"): 40.0}
    one = RL.clean_price_release(v1, region="B")
    assert one.count() == 1


def test_sinks(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    SK.write_table(df, f"{tmp_dir}/t", fmt="csv")
    back = spark.read.option("header", True).csv(f"{tmp_dir}/t")
    assert sorted(r.v for r in back.collect()) == ["a", "b"]
    SK.write_records_json(df, f"{tmp_dir}/j", as_single_array=True)
    txt = "".join(open(os.path.join(f"{tmp_dir}/j", f)).read() for f in os.listdir(f"{tmp_dir}/j") if f.startswith("part"))
    assert txt.strip().startswith("[{") and '"v":"b"' in txt


def test_incremental_refresh(spark, tmp_dir):
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    schema = StructType([StructField("year_month", StringType()), StructField("value", DoubleType()),
                         StructField("snapshot", StringType())])
    landing, target = f"{tmp_dir}/landing", f"{tmp_dir}/target"
    with pytest.raises(MissingSourceError):
        refresh(spark, landing, schema, target, ["year_month"], ["snapshot"], "year_month")
    _write(f"{landing}/a.csv", "year_month,value,snapshot\n2021-01,1.0,20240101\n2021-02,2.0,20240101\n")
    refresh(spark, landing, schema, target, ["year_month"], ["snapshot"], "year_month",
            checkpoint=f"{tmp_dir}/ck")
    _write(f"{landing}/b.csv", "year_month,value,snapshot\n2021-02,2.5,20240201\n2021-03,3.0,20240201\n")
    refresh(spark, landing, schema, target, ["year_month"], ["snapshot"], "year_month",
            checkpoint=f"{tmp_dir}/ck")
    got = {r.year_month: r.value for r in spark.read.parquet(target).collect()}
    assert got == {"2021-01": 1.0, "2021-02": 2.5, "2021-03": 3.0}


def test_unpivot_series_wide(spark):
    rows = [("Title", "CPIH annual rate", "CPI annual rate", "Unemployment"), ("2020 JAN", "1.0", "2.0", "4.0"),
            ("2020 FEB", "1.5", "2.5", "4.1")]
    df = spark.createDataFrame(rows, "_c0 string, _c1 string, _c2 string, _c3 string")
    got = {(r.title, r.label): r.value for r in RL.unpivot_series(df, ["annual rate"]).where("label != 'Title'").collect()}
    assert got == {("CPIH annual rate", "2020 JAN"): "1.0", ("CPIH annual rate", "2020 FEB"): "1.5",
                   ("CPI annual rate", "2020 JAN"): "2.0", ("CPI annual rate", "2020 FEB"): "2.5"}
    with pytest.raises(RL.SchemaError):
        RL.unpivot_series(df, ["house prices"])


def test_require_dates_and_expect_rows(spark):
    from panelkit.functions.dates import require_dates
    from panelkit.operators.quality import ContractError, expect_rows
    ok = spark.createDataFrame([("03/11/2021",), ("",)], "d string")
    assert require_dates(ok, "d") is ok
    with pytest.raises(ValueError):
        require_dates(spark.createDataFrame([("31/02/2021",)], "d string"), "d")
    assert expect_rows(ok, expected=2) == 2
    with pytest.raises(ContractError):
        expect_rows(ok, at_least=3)


@pytest.mark.parametrize("pad_old,pad_new", [(0, 400), (400, 0)])
def test_newest_release_file_wins(spark, tmp_dir, pad_old, pad_new):
    """Whatever their sizes (splits are packed by size), and each file's own title row decides its column."""
    months = [(2020, "JAN"), (2020, "FEB")]
    pad = "".join(f'"19{i % 70 + 10} Q1","0"\n' for i in range(400))

    def text(title_first, value, n):
        head = '"Title","RATE A","OTHER"\n' if title_first else '"Title","OTHER","RATE A"\n'
        rows = [f'"{y} {m}",' + (f'"{value}","9"' if title_first else f'"9","{value}"') for y, m in months]
        return head + pad[:n * 14] + "\n".join(rows) + "\n"

    _write(f"{tmp_dir}/r/rate_20240101.csv", text(True, "1.0", pad_old))
    _write(f"{tmp_dir}/r/rate_20240201.csv", text(False, "2.0", pad_new))
    s = RL.select_series(RL.read_release(spark, f"{tmp_dir}/r", ncols=3), "rate a")
    assert {r.value for r in RL.clean_monthly_release(s).collect()} == {2.0}
    u = RL.unpivot_series(RL.read_release(spark, f"{tmp_dir}/r", ncols=3), ["rate a"]).where("label = '2020 JAN'")
    assert sorted(r.value for r in u.collect()) == ["1.0", "2.0"]


def test_month_end_rate_keeps_missing_rates_in_both_layouts(spark):
    spine = spark.createDataFrame([(dt.date(2020, m, 1),) for m in (1, 2, 3)], "month date")
    old = spark.createDataFrame([("01 Jan 20", "0.75"), ("05 Feb 20", "n/a"), ("19 Mar 20", "0.1")], "`Date Changed` string, Rate string")
    new = spark.createDataFrame([("1 Jan 2020", "0.75"), ("5/2/2020", ""), ("19 March 2020", "0.1")], "DATE string, IUDBEDR string")
    for e in (old, new):
        assert {r.year_month: r.rate for r in RL.month_end_rate(e, spine).collect()} == {"2020-01": 0.75, "2020-02": None, "2020-03": 0.1}


def test_merge_moves_keys_between_partitions(spark, tmp_dir):
    from panelkit.streaming.incremental import merge_batch
    schema, target = "k string, p string, v int, stamp string, _source_file string", f"{tmp_dir}/t"
    merge_batch(spark.createDataFrame([("K1", "p1", 1, "1", "a"), ("K2", "p1", 1, "1", "a"), ("K3", "p3", 1, "1", "a")], schema), target, ["k"], ["stamp"], "p")
    second = spark.createDataFrame([("K1", "p2", 2, "2", "b"), ("K3", "p2", 2, "1", "b"), ("K3", "p2", 9, "1", "a")], schema)
    for _ in range(2):  # a rerun changes nothing
        merge_batch(second, target, ["k"], ["stamp"], "p")
        got = sorted((r.k, r.p, r.v) for r in spark.read.schema(schema).parquet(target).collect())
        assert got == [("K1", "p2", 2), ("K2", "p1", 1), ("K3", "p2", 2)]
    late = spark.createDataFrame([("K1", "p1", 7, "0", "c")], schema)  # older than what is there
    merge_batch(late, target, ["k"], ["stamp"], "p")
    assert ("K1", "p2", 2) in {(r.k, r.p, r.v) for r in spark.read.schema(schema).parquet(target).collect()}


def test_single_array_json(spark, tmp_dir):
    import json
    for n in (0, 1, 2500):
        SK.write_records_json(spark.range(n).withColumn("v", F.lit("x")), f"{tmp_dir}/a{n}", as_single_array=True)
        files = [f for f in os.listdir(f"{tmp_dir}/a{n}") if f.startswith("part")]
        assert len(files) == 1
        rows = json.load(open(f"{tmp_dir}/a{n}/{files[0]}"))
        assert sorted(r["id"] for r in rows) == list(range(n))


def test_single_array_json_keeps_upstream_parallel(spark, tmp_dir):
    import json
    SK.write_records_json(spark.range(0, 100, 1, 4).withColumn("p", F.spark_partition_id()), f"{tmp_dir}/a", as_single_array=True)
    files = [f for f in os.listdir(f"{tmp_dir}/a") if f.startswith("part")]
    rows = json.load(open(f"{tmp_dir}/a/{files[0]}"))
    assert len(files) == 1 and [r["id"] for r in rows] == list(range(100)) and len({r["p"] for r in rows}) == 4


def test_checkpoint_dir_needs_a_shared_folder(spark, monkeypatch):
    from panelkit import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), type("C", (), {"get": staticmethod(lambda k, d=None: d)})()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def test_drop_tables_removes_what_was_written(spark, tmp_dir):
    from panelkit import session
    local = lambda df: df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    with session.table_scope(spark):
        outer = session.cut_lineage(spark.range(10))
        with session.table_scope(spark):
            inner = session.cut_lineage(spark.range(5))
            paths = [local(outer), local(inner)]
            assert outer.count() == 10 and inner.count() == 5
        assert os.path.isdir(paths[0]) and not os.path.isdir(paths[1])
        session.drop_tables(spark)
        assert not os.path.isdir(paths[0])
