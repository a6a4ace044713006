"""Every registered query against its SQL twin, on the smallest data."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 5) + 0.0)
    return str(v)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in entry.oracle_sql():
        assert got
        return
    out = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in out.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
