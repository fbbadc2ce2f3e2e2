import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from stationflow.operators.flatten import flatten_snapshots
from stationflow.plans.maintenance import repair_stored
from stationflow.sources import sinks, tables
from stationflow.sources.snapshots import read_snapshots
from stationflow.streaming.ingest import ingest_stream

from conftest import records_df, ts
from test_flatten import _doc, _rec

S = "EN SERVICE"


def test_partitioned_append_and_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "records")
    r = records_df(spark, [(1, S, 1, 0, "2024-01-01 10:00:00"), (1, S, 2, 0, "2024-01-02 10:00:00")])
    sinks.append_records(r, path)
    parts = sorted(d for d in os.listdir(path) if d.startswith("record_date="))
    assert parts == ["record_date=2024-01-01", "record_date=2024-01-02"]
    fix = records_df(spark, [(1, S, 7, 0, "2024-01-02 11:00:00")])
    sinks.overwrite_records(fix, path)              # replaces 2024-01-02 only
    back = sinks.read_records(spark, path)
    assert sorted(x.nb_available_bikes for x in back.collect()) == [1, 7]
    pruned = back.where(F.col("record_date") == "2024-01-01")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "record_date" in plan and pruned.count() == 1
    assert tables.row_count(back).first().row_count == 2


def test_tables_ddl_backup_and_stage(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS t_records")
    spark.sql("DROP TABLE IF EXISTS t_records_backup")
    tables.create_records_table(spark, "t_records", str(tmp_path / "t_records"))
    r = records_df(spark, [(1, S, 1, 0, "2024-01-01 10:00:00")])
    tables.insert_records(r, "t_records")
    tables.backup_table(spark, "t_records", "t_records_backup")
    assert spark.table("t_records_backup").count() == 1
    tables.stage(r, "staging_records")
    assert spark.table("staging_records").count() == 1
    tables.drop_stage(spark, "staging_records")
    spark.sql("DROP TABLE t_records")
    spark.sql("DROP TABLE t_records_backup")


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    os.makedirs(src)
    for i in range(3):
        recs = [_rec(str(k), bikes=k + i, t=f"2023-09-27T08:0{i}:00Z") for k in range(1, 4)]
        with open(os.path.join(src, f"data___2023_09_27_10_0{i}_00.json"), "w") as fh:
            fh.write(json.dumps(_doc(recs)))
    q = ingest_stream(spark, src, sink, ckpt, available_now=True)
    q.awaitTermination(120)
    streamed = sinks.read_records(spark, sink).drop("record_date")
    batch = flatten_snapshots(read_snapshots(spark, src))
    assert streamed.count() == 9
    assert streamed.subtract(batch).count() == 0 and batch.subtract(streamed).count() == 0
    q = ingest_stream(spark, src, sink, ckpt, available_now=True)   # restart: nothing new
    q.awaitTermination(120)
    assert sinks.read_records(spark, sink).count() == 9


def test_stream_table_takes_appends_and_repairs_and_replays_nothing(spark, tmp_path):
    src, sink, ckpt, bad = (str(tmp_path / n) for n in ("src", "sink", "ckpt", "bad"))
    os.makedirs(src)
    docs = [json.dumps(_doc([_rec("1", t="2023-09-20T08:00:00Z"), _rec("x", t="2023-09-20T08:00:00Z")])),
            json.dumps(_doc([])), '{"nhits": 1, "records": [{"da']
    for i, doc in enumerate(docs):
        with open(os.path.join(src, f"data___{i}.json"), "w") as fh:
            fh.write(doc)
    ingest_stream(spark, src, sink, ckpt, available_now=True, strict=False, quarantine_path=bad).awaitTermination(120)
    assert sorted(r.reason for r in spark.read.json(bad).collect()) == ["bad_id", "corrupt", "empty"]
    sinks.append_records(records_df(spark, [(2, S, 5, 0, "2023-09-27 09:00:00")]), sink)
    assert sorted(r.station_id for r in sinks.read_records(spark, sink).collect()) == [1, 2]
    repair_stored(spark, sink, "2023-09-27 00:00:00 UTC", "2023-09-27 23:00:00 UTC")
    got = sorted((r.station_id, r.record_timestamp) for r in sinks.read_records(spark, sink).collect())
    assert got == [(1, ts("2023-09-20 08:00")), (1, ts("2023-09-27 08:00"))]
    # A batch whose commit was lost is replayed: its finished folder has nothing left to move.
    for kind in ("commits",):
        for f in os.listdir(os.path.join(ckpt, kind)):
            os.replace(os.path.join(ckpt, kind, f), str(tmp_path / f"lost-{f}"))
    ingest_stream(spark, src, sink, ckpt, available_now=True, strict=False, quarantine_path=bad).awaitTermination(120)
    assert sinks.read_records(spark, sink).count() == 2
    assert spark.read.json(bad).count() == 3


def test_stream_without_quarantine_drops_nothing_unseen(spark, tmp_path):
    src = str(tmp_path / "src")
    os.makedirs(src)
    with open(os.path.join(src, "data___0.json"), "w") as fh:
        fh.write('{"nhits": 1, "records": [{"da')
    q = ingest_stream(spark, src, str(tmp_path / "sink"), str(tmp_path / "ckpt"), available_now=True)
    with pytest.raises(Exception, match="rejects"):
        q.awaitTermination(120)
