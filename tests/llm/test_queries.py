import base64
import hashlib
import re

import duckdb
import pytest

import __spark_entry__ as entry
from stationflow.llm import queries
from tools.oracle_check import frame_hash


def test_one_query_for_each_operator_and_the_pipeline():
    names = entry.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()) == list(range(1, 14))
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    assert set(queries.oracle_sql()) <= set(entry.oracle_sql()) <= set(names)


SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, exp = entry.queries()[name](spark, SF).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns) and frame_hash(got) == frame_hash(exp)


def test_pages_come_back_from_the_archive(spark):
    got = {r.page_id: r for r in entry.queries()["op5_warc"](spark, SF).collect()}
    for p in spark.read.parquet(f"{SF}/pages.parquet").collect():
        payload = (p.html or "").encode()
        r = got[p.page_id]
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r.record_type, r.refers_to) == ("response", None) or got[r.refers_to].payload_digest == r.payload_digest
