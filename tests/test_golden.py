"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from stationflow.plans import catalog, changes, lifecycle
from tools.oracle_check import TABLES, frame_hash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables missing")


QUERIES = catalog.queries() | lifecycle.QUERIES | changes.QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_mod.queries()) and set(QUERIES) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = entry_mod.queries()[name](spark, SF).toPandas()
    exp = duck.execute(entry_mod.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert frame_hash(got) == frame_hash(exp)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0 and df.columns == ["local_date", "hour_of_day", "borrowed", "returned"]
