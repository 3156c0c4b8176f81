"""Every registered query at sf0.001 against its DuckDB oracle (the same
compare the driver runs at sf0.01), plus the entry smoke check."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from panelkit.plans.tables import TABLES
from tests.conftest import SF
from tools.check import _digest

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "year_month" in df.columns


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    cur = con.execute(sql)
    ocols = [c[0] for c in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows)[0] == _digest(ocols, orows)[0]
