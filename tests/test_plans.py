"""Every query with SQL gives the same rows in both engines."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.verify import TABLES, canon

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


CORE = sorted(name for name in entry.oracle_sql() if not name.startswith(("p1_", "p4_", "p8_")))


@pytest.mark.parametrize("name", CORE)
def test_same_rows(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(canon(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert sorted(names) == cols
    assert got == sorted(tuple(canon(r[i]) for i in order) for r in cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["source", "source_id", "run_date", "change_kind"]
