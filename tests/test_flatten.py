import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from stationflow.operators import flatten, repair
from stationflow.schemas import RECORD_COLUMNS, SNAPSHOT
from stationflow.sources.snapshots import file_report, read_snapshots, with_source_file

from conftest import rows, ts


def _rec(libelle="12", bikes=3, places=5, t="2023-09-27T08:00:00Z", etat="EN SERVICE", nom="A"):
    fields = {"libelle": libelle, "nom": nom, "adresse": "1 RUE X", "commune": "C",
              "type": "AVEC TPE", "etat": etat, "etatconnexion": "CONNECTED",
              "nbvelosdispo": bikes, "nbplacesdispo": places, "geo": [50.6, 3.05],
              "localisation": [50.6, 3.05], "datemiseajour": "2023-09-27T10:00:00+02:00"}
    fields = {k: v for k, v in fields.items() if v is not None}
    return {"datasetid": "d", "recordid": f"r{libelle}", "record_timestamp": t,
            "fields": fields, "geometry": {"type": "Point", "coordinates": [3.05, 50.6]}}


def _doc(records):
    return {"nhits": len(records or []), "parameters": {"dataset": "d", "rows": 300, "start": 0,
                                                        "format": "json", "timezone": "Europe/Paris"},
            "records": records}


@pytest.fixture()
def snapshot_dir(tmp_path):
    docs = {
        "data___2023_09_27_10_00_00.json": [_doc([_rec("12"), _rec("13", bikes=0)])],
        "data___2023_09_27_10_01_00.json": [_doc([])],           # empty records
        "data___2023_09_27_10_02_00.json": [_doc(None)],         # null records
        "data___2023_09_27_10_03_00.json": [_doc([_rec("12", bikes=None, t="2023-09-27T08:03:00Z"),
                                                  _rec(None, t="2023-09-27T08:03:00Z")])],
    }
    for name, content in docs.items():
        (tmp_path / name.replace(":", "_")).write_text("\n".join(json.dumps(d) for d in content))
    (tmp_path / "data___2023_09_27_10_04_00.json").write_text('{"nhits": 1, "records": [{"data')
    return str(tmp_path)


def test_scan_counts_rejects_and_rows(spark, snapshot_dir):
    snaps = read_snapshots(spark, snapshot_dir, keep_corrupt=True)
    rep = flatten.load_report(snaps).first()
    assert (rep.documents, rep.corrupt, rep.station_rows, rep.bad_ids, rep.loaded_rows) == (5, 1, 4, 1, 3)
    assert rep.empty == 2 and tuple(file_report(snaps).first()) == (5, 5)
    assert sorted(r.reason for r in flatten.rejects(snaps).collect()) == ["bad_id", "corrupt", "empty", "empty"]
    named = with_source_file(read_snapshots(spark, snapshot_dir))
    caps = {r.source_file: r.captured_at for r in named.collect()}
    assert caps["data___2023_09_27_10_00_00.json"] == ts("2023-09-27 08:00:00")


def test_flatten_unnests_and_drops_empty(spark, snapshot_dir):
    flat = flatten.flatten_snapshots(read_snapshots(spark, snapshot_dir))
    assert flat.columns == RECORD_COLUMNS
    got = rows(flat.select("station_id", "nb_available_bikes", "last_update"), "record_timestamp",
               "station_id")
    assert got == [(12, 3, ts("2023-09-27 08:00")), (13, 0, ts("2023-09-27 08:00")),
                   (None, 3, ts("2023-09-27 08:00")), (12, None, ts("2023-09-27 08:00"))] or \
        sorted(got, key=str) == sorted([(12, 3, ts("2023-09-27 08:00")), (13, 0, ts("2023-09-27 08:00")),
                                        (None, 3, ts("2023-09-27 08:00")),
                                        (12, None, ts("2023-09-27 08:00"))], key=str)


def test_non_numeric_libelle_strict_fails_lenient_drops(spark, tmp_path):
    p = tmp_path / "data___x.json"
    p.write_text(json.dumps(_doc([_rec("abc"), _rec("5")])))
    snaps = read_snapshots(spark, str(p))
    with pytest.raises(Exception):
        flatten.flatten_snapshots(snaps, strict=True).collect()
    loose = repair.backfill(snaps, "2000-01-01 00:00:00 UTC", "2100-01-01 00:00:00 UTC", strict=False)
    assert [r.station_id for r in loose.collect()] == [5]


def test_backfill_window_edges_and_null_timestamp(spark):
    recs = [_rec("1", t="2023-09-27T00:00:00Z"), _rec("2", t="2023-09-28T00:00:00Z"),
            _rec("3", t="2023-09-27T12:00:00Z"), _rec("4", t=None), _rec("5", t="2023-09-26T23:59:59Z")]
    snaps = spark.createDataFrame([json.dumps(_doc(recs))], "string") \
        .select(F.from_json("value", SNAPSHOT).alias("d")).select("d.*")
    out = repair.backfill(snaps, "2023-09-27 00:00:00 UTC", "2023-09-28 00:00:00 UTC")
    assert sorted(r.station_id for r in out.collect()) == [1, 3, 4]


def test_nested_arrays_and_zip_back(spark):
    recs = [_rec("1", bikes=1), _rec("2", bikes=2), _rec("3", bikes=3)]
    snaps = spark.createDataFrame([json.dumps(_doc(recs))], "string") \
        .select(F.from_json("value", SNAPSHOT).alias("d")).select("d.*")
    arrays = flatten.nested_arrays(snaps)
    assert arrays.first().nb_available_bikes == [1, 2, 3]
    back = flatten.zip_arrays_to_rows(arrays, ["station_id", "nb_available_bikes"])
    assert rows(back, "station_id") == [("1", 1), ("2", 2), ("3", 3)]
    assert flatten.replicate(back, 3).count() == 9


def test_dimension_and_realtime(spark):
    recs1 = [_rec("12", nom="Old", t="2023-09-27T08:00:00Z"), _rec("13", t="2023-09-27T08:00:00Z")]
    recs2 = [_rec("12", nom="New", bikes=8, t="2023-09-27T08:01:00Z")]
    snaps = spark.createDataFrame([json.dumps(_doc(recs1)), json.dumps(_doc(recs2))], "string") \
        .select(F.from_json("value", SNAPSHOT).alias("d")).select("d.*")
    dim = {r.id: r for r in flatten.stations_from_snapshots(snaps).collect()}
    assert dim[12].name == "New" and dim[12].latitude == 50.6 and set(dim) == {12, 13}
    rt = flatten.realtime_stations(snaps, station="12").collect()
    assert len(rt) == 1 and rt[0].nb_available_bikes == 8 and len(rt[0]) == 13
    assert flatten.expected_rows(snaps).first().station_rows == 3
