import os

from pyspark.sql import functions as F

from stationflow.operators import frames
from stationflow.sources.csvio import read_csv
from stationflow.sources.sinks import read_timemap_csv, write_frames_json, write_timemap_csv

from conftest import records_df

S = "EN SERVICE"


def _stations(spark):
    return spark.createDataFrame([(1, "A", 50.1, 3.1), (2, "B", 50.2, 3.2), (3, "C", 50.3, 3.3)],
                                 "id bigint, name string, latitude double, longitude double")


def test_frames_order_and_repeat(spark, tmp_path):
    r = records_df(spark, [(2, S, 1, 1, "2024-01-01 10:00:10"), (1, S, 3, 1, "2024-01-01 10:00:10"),
                           (3, "IN_MAINTENANCE", 3, 1, "2024-01-01 10:00:10"),
                           (1, S, 0, 0, "2024-01-01 10:02:00")])
    f = frames.animation_frames(r, _stations(spark), tz="UTC").orderBy("minute").collect()
    assert [x.minute for x in f] == ["2024-01-01 10:00", "2024-01-01 10:01", "2024-01-01 10:02"]
    assert f[0].latitude == [50.1, 50.2] and f[0].taux_velos_dispo == [0.75, 0.5]
    assert f[1].latitude == f[0].latitude                   # missing minute repeats the frame
    assert f[2].taux_velos_dispo == [None]                   # 0 docks → null ratio
    out = str(tmp_path / "frames")
    write_frames_json(frames.animation_frames(r, _stations(spark), tz="UTC"), out)
    assert spark.read.json(out).count() == 3


def test_timemap_frames_and_csv_per_index(spark, tmp_path):
    r = records_df(spark, [(1, S, 3, 1, "2024-01-01 10:00:10"), (2, S, 0, 0, "2024-01-01 10:00:20"),
                           (4, S, 3, 1, "2024-01-01 10:01:00"), (3, S, None, 1, "2024-01-01 10:02:00")])
    rows = frames.timemap_rows(r, _stations(spark))
    nan = spark.createDataFrame([(r.first().record_timestamp, 1.0, 1.0, 1, float("nan"))],
                                rows.schema)
    f = frames.timemap_frames(rows.unionByName(nan))
    assert sorted(x.time_index for x in f.collect()) == ["1000"]
    assert [x.time_index for x in frames.frame_keys(f).collect()] == ["1000"]
    out = str(tmp_path / "timemap")
    write_timemap_csv(f, out)
    assert [d for d in os.listdir(out) if d.startswith("time_index=")] == ["time_index=1000"]
    back = read_csv(spark, os.path.join(out, "time_index=1000"))
    assert back.count() == 1 and back.first().latitude == 50.1


def test_frames_follow_instants_across_clock_changes(spark):
    """As many frames as minutes pass, in autumn (an hour twice) and in spring (one skipped)."""
    for times, n in ((["2024-10-27 00:30:00", "2024-10-27 01:30:00", "2024-10-27 01:31:00"], 62),
                     (["2024-03-31 00:59:00", "2024-03-31 01:00:00"], 2)):
        r = records_df(spark, [(1, S, 1, 1, t) for t in times])
        e = frames.frame_entries(frames.frame_points(r, _stations(spark), tz="Europe/Paris"), "Europe/Paris")
        assert e.select("minute").distinct().count() == e.count() == n
        assert frames.animation_frames(r, _stations(spark), tz="Europe/Paris").count() == n
    labels = [x.local_minute.strftime("%H:%M") for x in e.orderBy("minute").collect()]
    assert labels == ["01:59", "03:00"]


def test_timemap_csv_has_one_file_a_frame_and_keeps_labels(spark, tmp_path):
    data = [(k, S, 3, 1, f"2024-01-01 {h:02d}:30:00") for h in range(3) for k in (1, 2, 3)]
    rows = frames.timemap_frames(frames.timemap_rows(records_df(spark, data).repartition(6), _stations(spark)))
    out = str(tmp_path / "timemap")
    write_timemap_csv(rows, out)
    for day in (d for d in os.listdir(out) if d.startswith("time_index=")):
        assert len([f for f in os.listdir(os.path.join(out, day)) if f.endswith(".csv")]) == 1
    back = read_timemap_csv(spark, out)
    assert {x.time_index for x in back.collect()} == {"0030", "0130", "0230"} and back.count() == 9
    assert frames.frame(back, "0030").count() == 3
