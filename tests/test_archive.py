"""The archive of captures: names, the repeated hour, repeated batches, failures."""

import os

from pyspark.sql import functions as F

from stationflow.functions.codec import capture_file_name, capture_time_from_name
from stationflow.sources import archive
from stationflow.sources.snapshots import read_snapshots, with_source_file
from tests.conftest import ts

TIMES = ["2024-10-26 23:30:00", "2024-10-27 00:30:00", "2024-10-27 01:30:00", "2024-10-27 02:30:00", "2024-03-31 00:30:00",
         "2024-03-31 01:30:00", "2024-07-01 12:00:05"]


def snapshots(spark, times, dataset="d"):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(times)], "nhits int, t string")
    return df.select("nhits", F.struct(F.lit(dataset).alias("dataset")).alias("parameters"),
                     F.to_timestamp(F.concat("t", F.lit("Z"))).alias("captured_at"))


def files(path):
    return sorted(f for d in os.listdir(path) if d.startswith("capture_date=") for f in os.listdir(f"{path}/{d}")
                  if not f.startswith("."))


def back(spark, path):
    rows = with_source_file(read_snapshots(spark, path)).select("nhits", "captured_at").collect()
    return sorted(map(tuple, rows), key=str)


def test_names_tell_every_instant_again(spark):
    for tz in ("Europe/Paris", "America/New_York", "Australia/Lord_Howe", "+02:00", "UTC"):
        hours = spark.sql("select explode(sequence(timestamp'2024-01-01', timestamp'2025-01-01', interval 30 minutes)) as t")
        named = hours.select("t", capture_file_name("t", tz).alias("name"))
        wrong = named.where(~capture_time_from_name("name", tz).eqNullSafe(F.col("t")))
        assert wrong.count() == 0 and named.select("name").distinct().count() == named.count(), tz


def test_one_file_a_capture(spark, tmp_path):
    path = str(tmp_path / "archive")
    docs = snapshots(spark, TIMES)
    archive.archive_captures(docs.unionByName(docs), path)
    names = files(path)
    assert len(names) == len(TIMES) and "data___2024_10_27_02_30_00.json" in names
    assert "data___2024_10_27_02_30_00__2.json" in names and "data___2024_07_01_14_00_05.json" in names
    assert back(spark, path) == sorted([(n, ts(t)) for n, t in enumerate(TIMES) for _ in range(2)], key=str)


def test_batches_repeat_and_captures_are_added_to(spark, tmp_path):
    path = str(tmp_path / "archive")
    docs = snapshots(spark, TIMES)
    for _ in range(3):
        archive.archive_captures(docs, path, batch="b1")
    assert len(files(path)) == len(TIMES)
    archive.archive_captures(docs, path, batch="b2")  # the same captures from another load
    assert len(files(path)) == 2 * len(TIMES)
    assert back(spark, path) == sorted([(n, ts(t)) for n, t in enumerate(TIMES) for _ in range(2)], key=str)


def test_a_failure_between_moves_is_mended(spark, tmp_path, monkeypatch):
    path, real, calls = str(tmp_path / "archive"), archive._renamed, []

    def failing(*args):
        calls.append(1)
        if len(calls) > 3:
            raise OSError("store is away")
        return real(*args)

    monkeypatch.setattr(archive, "_renamed", failing)
    try:
        archive.archive_captures(snapshots(spark, TIMES), path, batch="b")
        raise AssertionError("the failure was hidden")
    except OSError:
        pass
    monkeypatch.setattr(archive, "_renamed", real)
    archive.archive_captures(snapshots(spark, TIMES), path, batch="b")
    assert len(files(path)) == len(TIMES)
    assert back(spark, path) == sorted([(n, ts(t)) for n, t in enumerate(TIMES)], key=str)


def test_without_a_time_and_without_documents(spark, tmp_path):
    path = str(tmp_path / "archive")
    archive.archive_captures(snapshots(spark, [None, TIMES[0]]), path)
    archive.archive_captures(snapshots(spark, TIMES).limit(0), path)
    assert files(path) == ["data___2024_10_27_01_30_00.json", "unknown.json"]
    assert back(spark, path) == [(0, None), (1, ts(TIMES[0]))]
