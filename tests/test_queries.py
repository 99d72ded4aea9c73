"""Every registered query against its SQL on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from lotledger.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents"
          " embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(v) for v in r) for r in df.select(columns).collect()), key=repr)
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=repr)
    assert rows == want


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(entry.queries())
