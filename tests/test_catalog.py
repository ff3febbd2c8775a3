"""Every registered query against its oracle, and the driver contract."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from convolake import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(round(v, 6) + 0.0) if isinstance(v, float) else repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in catalog.ORACLES:
        rows = duck.execute(catalog.ORACLES[name])
        names = [d[0] for d in rows.description]
        assert sorted(names) == columns
        assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in rows.fetchall())
    else:
        assert got


def test_contract(spark):
    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
