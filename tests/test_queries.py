"""Every query of the core beside its SQL in DuckDB, on the small tables."""

import math
import os

import duckdb
import pytest

from asofia.plans import queries as Q
from asofia.plans import values

assert values.loaded()

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in TABLES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{DIR}/{n}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 9) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_query(spark, duck, name):
    got = Q.QUERIES[name](spark, DIR)
    rows = got.collect()
    if name not in Q.SQL:
        assert rows
        return
    cursor = duck.execute(Q.SQL[name])
    cols = sorted(c[0] for c in cursor.description)
    order = [[c[0] for c in cursor.description].index(x) for x in cols]
    want = sorted([tuple(plain(r[i]) for i in order) for r in cursor.fetchall()], key=str)
    assert cols == sorted(got.columns)
    assert sorted([tuple(plain(r[c]) for c in cols) for r in rows], key=str) == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
