"""Feeds with unknown and retyped fields: nothing is lost, and the report says what differs."""

import json

import pytest

from stationflow.sources import drift
from tests.conftest import ts

AT = "2024-01-01T10:00:00.123456Z"


@pytest.fixture
def load(spark, tmp_path):
    def run(*lines):
        path = tmp_path / "feed.json"
        path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
        return drift.read_variants(spark, str(path))
    return run


def one(fields, **beside):
    return {"nhits": 1, "records": [{"fields": fields, "record_timestamp": AT, **beside}]}


def test_known_feed_has_nothing_unknown(load):
    docs = load(one({"libelle": "12", "nbvelosdispo": 7, "etat": "EN SERVICE", "geo": [1.5, 2], "adresse": None}))
    row = drift.flatten_variants(docs).first()
    assert (row.station_id, row.nb_available_bikes, row.operational_state, row.unknown) == (12, 7, "EN SERVICE", None)
    assert row.record_timestamp == ts("2024-01-01 10:00:00.123456")
    assert drift.drift_report(docs).count() == 0


@pytest.mark.parametrize("fields, bikes, unknown", [
    ({"nbvelosdispo": "7"}, 7, None),
    ({"nbvelosdispo": "seven"}, None, {"fields": {"nbvelosdispo": "seven"}}),
    ({"nbvelosdispo": 7.5}, 7, {"fields": {"nbvelosdispo": 7.5}}),
    ({"nbvelosdispo": {"n": 7}}, None, {"fields": {"nbvelosdispo": {"n": 7}}}),
    ({"nbvelosdispo": None}, None, None),
    ({"nbvelosdispo": 7, "ebike": [1, {"a": None}], "new": True}, 7, {"fields": {"ebike": [1, {"a": None}], "new": True}}),
])
def test_values_are_cast_or_kept(load, fields, bikes, unknown):
    row = drift.flatten_variants(load(one(fields))).first()
    assert row.nb_available_bikes == bikes
    assert (row.unknown and json.loads(row.unknown)) == unknown


def test_what_stands_beside_the_fields_is_kept(load):
    docs = load(one({"libelle": "1"}, links=["x"]), one("none at all"), {"records": ["text", None, 3]},
                {"records": [{"record_timestamp": "soon"}]})
    got = [json.loads(r.unknown) if r.unknown else None for r in drift.flatten_variants(docs).collect()]
    want = [{"record": {"links": ["x"]}}, {"record": {"fields": "none at all"}}, {"value": "text"}, None, {"value": 3},
            {"record": {"record_timestamp": "soon"}}]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_report_by_path_and_kind(load):
    docs = load(one({"libelle": 12, "ebike": 1}), one({"libelle": "12", "ebike": "1", "geo": ["1", 2]}),
                {"nhits": None, "records": {"a": 1}, "extra": {"b": {"c": 1}}}, "{broken", "")
    got = {(r.path, r.kind, r.status, r.n) for r in drift.drift_report(docs).collect()}
    assert got == {("$.records[].fields.libelle", "number", "retyped", 1), ("$.records[].fields.ebike", "number", "added", 1),
                   ("$.records[].fields.ebike", "text", "added", 1), ("$.records[].fields.geo[]", "text", "retyped", 1),
                   ("$.records", "object", "retyped", 1), ("$.extra", "object", "added", 1)}
    assert [r.line for r in docs.where("raw is null").collect()] == ["{broken"]
    assert drift.flatten_variants(docs).count() == 2


def test_empty_folder_of_lines(load):
    docs = load("")
    assert docs.count() == 0 and drift.flatten_variants(docs).count() == 0 and drift.drift_report(docs).count() == 0


def test_report_reads_the_documents_once(load):
    docs = load(one({"libelle": 12}))
    plan = drift.drift_report(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 1


def test_report_goes_down_as_far_as_told(load):
    from pyspark.sql import types as T
    schema = T.StringType()
    for _ in range(9):
        schema = T.StructType([T.StructField("a", schema)])

    def nested(levels, value):
        for _ in range(levels):
            value = {"a": value}
        return value

    got = drift.drift_report(load(nested(7, {"b": True}), nested(6, {"b": True}), nested(6, None), [1]), schema).collect()
    assert {(r.path, r.kind, r.status, r.n) for r in got} == {
        ("$.a.a.a.a.a.a.b", "boolean", "added", 1), ("$", "array", "retyped", 1)}


def test_report_counts_every_batch_and_kind(spark, tmp_path):
    path = str(tmp_path / "many")
    line = '{"nhits": 1.5e300, "new": 12345678901234567890123456789012345678901, "records": [{"fields": {"etat": true}}, "x"]}'
    spark.range(0, 25_000, 1, 3).selectExpr(f"'{line}' AS value").write.text(path)
    got = {(r.path, r.kind, r.status, r.n) for r in drift.drift_report(drift.read_variants(spark, path)).collect()}
    assert got == {("$.new", "number", "added", 25_000), ("$.records[].fields.etat", "boolean", "retyped", 25_000),
                   ("$.records[]", "text", "retyped", 25_000)}
