"""Every query of the engine beside its SQL on the smallest tables."""

import glob

import duckdb
import pytest

import __spark_entry__ as entry
from gridloom.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {path.rpartition('/')[2][:-8]} AS SELECT * FROM '{path}'")
    return c


@pytest.mark.parametrize("name", sorted(REGISTRY.oracles))
def test_equals_sql(spark, con, name):
    df = REGISTRY.queries[name](spark, SF)
    names = sorted(df.columns)
    want = con.sql(REGISTRY.oracles[name])
    assert sorted(want.columns) == names
    at = [want.columns.index(n) for n in names]
    assert sorted((tuple(r[n] for n in names) for r in df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)


def test_entry(spark):
    assert entry.entry(spark).count() == 1 and set(entry.oracle_sql()) <= set(entry.queries())
