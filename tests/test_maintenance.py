import json
import os

from pyspark.sql import functions as F

from stationflow.operators.filters import time_range
from stationflow.operators.repair import repair_window
from stationflow.plans.maintenance import load_window, merge_latest, read_latest, repair_stored
from stationflow.sources import dated, sinks

from conftest import records_df
from test_flatten import _doc, _rec

S = "EN SERVICE"


def test_load_window_append_then_replace(spark, tmp_path):
    raw, fact = str(tmp_path / "raw"), str(tmp_path / "fact")
    os.makedirs(raw)
    with open(os.path.join(raw, "data___a.json"), "w") as fh:
        fh.write(json.dumps(_doc([_rec("1", t="2023-09-27T08:00:00Z"), _rec("2", t="2023-09-28T08:00:00Z"),
                                  _rec("3", t="2023-09-29T08:00:00Z")])))
    load_window(spark, raw, fact, "2023-09-27 00:00:00 UTC", "2023-09-29 00:00:00 UTC")
    load_window(spark, raw, fact, "2023-09-27 00:00:00 UTC", "2023-09-29 00:00:00 UTC")
    assert sinks.read_records(spark, fact).count() == 4          # plain append duplicates
    load_window(spark, raw, fact, "2023-09-27 00:00:00 UTC", "2023-09-29 00:00:00 UTC", replace=True)
    assert sorted(r.station_id for r in sinks.read_records(spark, fact).collect()) == [1, 2]


def test_repair_stored_rewrites_only_touched_dates(spark, tmp_path):
    fact = str(tmp_path / "fact")
    data = [(k, S, d, 0, f"2023-11-{d:02d} {h:02d}:00:00") for k in (1, 2) for d in range(10, 25)
            for h in (1, 12, 23)]
    r = records_df(spark, data)
    dated.append(sinks.with_record_date(r), fact)
    before = set(dated.read(spark, fact).where("record_date = '2023-11-10'").inputFiles())
    dates = repair_stored(spark, fact, "2023-11-22 10:00:00 UTC", "2023-11-23 13:40:00 UTC",
                          backup_path=str(tmp_path / "backup"))
    assert [d.isoformat() for d in dates] == ["2023-11-22", "2023-11-23"]
    got = sinks.read_records(spark, fact).drop("record_date")
    exp = repair_window(r, "2023-11-22 10:00:00 UTC", "2023-11-23 13:40:00 UTC")
    assert got.subtract(exp).count() == 0 and exp.subtract(got).count() == 0
    after = set(dated.read(spark, fact).where("record_date = '2023-11-10'").inputFiles())
    assert before <= after and {"record_date=" + d.isoformat() for d in dates} == {
        p for g in os.listdir(fact) if g.startswith("gen=") and g != "gen=0"
        for p in os.listdir(os.path.join(fact, g)) if p.startswith("record_date=")}
    assert spark.read.parquet(str(tmp_path / "backup")).count() == 12


def test_time_range_prunes_date_partitions(spark, tmp_path):
    fact = str(tmp_path / "fact")
    sinks.append_records(records_df(spark, [(1, S, 1, 0, "2024-01-01 10:00:00"),
                                            (1, S, 2, 0, "2024-01-05 10:00:00")]), fact)
    df = time_range(sinks.read_records(spark, fact), "2024-01-05 00:00:00 UTC",
                    "2024-01-06 00:00:00 UTC")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(record_date" in plan
    assert "record_timestamp" in plan.split("PushedFilters:")[1].split("]")[0]
    assert [x.nb_available_bikes for x in df.collect()] == [2]


def _raw(path, docs):
    os.makedirs(path, exist_ok=True)
    for i, doc in enumerate(docs):
        with open(os.path.join(path, f"data___{i}.json"), "w") as fh:
            fh.write(doc if isinstance(doc, str) else json.dumps(doc))


def test_replacing_half_a_day_keeps_the_other_half_and_rows_without_a_time(spark, tmp_path):
    raw, fact = str(tmp_path / "raw"), str(tmp_path / "fact")
    sinks.append_records(records_df(spark, [(1, S, 1, 0, "2023-09-27 06:00:00"), (2, S, 2, 0, "2023-09-27 14:00:00"),
                                            (3, S, 3, 0, None), (4, S, 3, 0, None), (5, S, 5, 0, "2023-09-28 08:00:00"),
                                            (6, S, 6, 0, "2023-09-29 08:00:00")]), fact)
    _raw(raw, [_doc([_rec("20", t="2023-09-27T15:00:00Z"), _rec("30", t=None), _rec("40", t="2023-09-27T05:00:00Z")])])
    load_window(spark, raw, fact, "2023-09-27 12:00:00 UTC", "2023-09-28 12:00:00 UTC", replace=True)
    got = sorted(r.station_id for r in sinks.read_records(spark, fact).collect())
    assert got == [1, 3, 4, 6, 20, 30]


def test_rejects_are_counted_and_kept(spark, tmp_path):
    raw, fact, bad = (str(tmp_path / n) for n in ("raw", "fact", "bad"))
    _raw(raw, [_doc([_rec("1", t="2023-09-27T08:00:00Z"), _rec("x", t="2023-09-27T08:00:00Z")]), _doc([]),
               '{"nhits": 1, "records": [{"data'])
    rep = load_window(spark, raw, fact, "2023-09-27 00:00:00 UTC", "2023-09-29 00:00:00 UTC", strict=False,
                      quarantine_path=bad).first()
    assert tuple(rep) == (3, 1, 1, 2, 1, 1)
    assert sorted(r.reason for r in spark.read.json(bad).collect()) == ["bad_id", "corrupt", "empty"]
    assert sinks.read_records(spark, fact).count() == 1


def test_latest_readings_are_merged_by_time(spark, tmp_path):
    path = str(tmp_path / "latest")
    merge_latest(spark, records_df(spark, [(1, S, 1, 0, "2024-01-01 10:00:00"), (2, S, 2, 0, "2024-01-01 10:00:00")]), path)
    merge_latest(spark, records_df(spark, [(1, S, 9, 0, "2024-01-01 09:00:00"), (2, S, 8, 0, "2024-01-01 11:00:00"),
                                           (3, S, 3, 0, "2023-01-01 00:00:00"), (None, S, 3, 0, "2025-01-01 00:00:00")]), path)
    assert {r.station_id: r.nb_available_bikes for r in read_latest(spark, path).collect()} == {1: 1, 2: 8, 3: 3}
