"""Key frames: the log against frames at full length, single minutes, windows, storage."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationflow.operators import frames, keyframes
from tests.conftest import ts

SCHEMA = "minute string, station_id bigint, record_timestamp string, latitude double, longitude double, taux_velos_dispo double"


def points_df(spark, entries):
    """(minute text, station, share) or (minute text, station, share, seconds)."""
    data = [(e[0], e[1], f"{e[0]}:{(e[3] if len(e) > 3 else 0):02d}", float(e[1]), 2.0, e[2]) for e in entries]
    df = spark.createDataFrame(data, SCHEMA)
    return df.withColumns({c: F.to_timestamp(F.concat(F.col(c), F.lit("Z"))) for c in ("record_timestamp",)}).withColumn(
        "minute", F.to_timestamp(F.concat("minute", F.lit(":00Z"))))


def dense(points):
    rows = frames.frame_entries(points, "UTC").select("minute", "station_id", *keyframes.VALUES)
    return Counter(tuple(r) for r in rows.collect())


def rebuilt(log, *bounds):
    return Counter(tuple(r) for r in keyframes.rebuild(log, *bounds).select("minute", "station_id", *keyframes.VALUES).collect())


FEED = [("2024-01-01 10:58", 1, 0.5), ("2024-01-01 10:58", 2, 0.5), ("2024-01-01 10:59", 1, 0.5), ("2024-01-01 10:59", 2, 0.25),
        ("2024-01-01 11:01", 1, 0.5), ("2024-01-01 13:10", 2, None), ("2024-01-01 13:11", 2, None), ("2024-01-01 13:12", 3, 1.0)]


def test_only_what_changes_is_kept(spark):
    log = keyframes.key_frames(points_df(spark, FEED))
    got = {(f"{r.minute:%H:%M}", r.kind, r.station_id) for r in log.collect()}
    assert got == {
        ("10:58", "key", 1), ("10:58", "key", 2), ("10:59", "change", 2),
        ("11:00", "key", 1), ("11:00", "key", 2), ("11:01", "gone", 2),
        ("12:00", "key", 1), ("13:00", "key", 1), ("13:10", "gone", 1), ("13:10", "change", 2),
        ("13:12", "gone", 2), ("13:12", "change", 3), ("13:13", "gone", 3)}
    assert rebuilt(log) == dense(points_df(spark, FEED))


def test_one_minute_and_a_window(spark):
    log = keyframes.key_frames(points_df(spark, FEED))

    def at(minute):
        return sorted((r.station_id, r.taux_velos_dispo) for r in keyframes.frame_at(log, minute).collect())
    assert at("2024-01-01 10:57:00Z") == [] and at("2024-01-01 13:13:00Z") == [] and at("2024-01-02 10:58:00Z") == []
    assert at("2024-01-01 10:59:30Z") == [(1, 0.5), (2, 0.25)] and at("2024-01-01 11:00:00Z") == at("2024-01-01 10:59:00Z")
    assert at("2024-01-01 12:34:00Z") == [(1, 0.5)] and at("2024-01-01 13:11:00Z") == [(2, None)]
    lo, hi = ts("2024-01-01 10:59"), ts("2024-01-01 11:02")
    full = dense(points_df(spark, FEED))
    want = Counter({k: n for k, n in full.items() if lo <= k[0] < hi})
    assert rebuilt(log, "2024-01-01 10:59:00Z", "2024-01-01 11:02:00Z") == want


def test_repeated_readings_and_no_points(spark):
    twice = [("2024-01-01 10:00", 1, 0.5, 1), ("2024-01-01 10:00", 1, 0.75, 30), ("2024-01-01 10:00", 1, 0.75, 30),
             ("2024-01-01 10:01", 1, 0.5, 1)]
    points = points_df(spark, twice)
    log = keyframes.key_frames(points)
    assert rebuilt(log) == dense(points)
    assert log.where("kind = 'gone' and minute = timestamp'2024-01-01 10:01:00'").count() == 2
    assert keyframes.key_frames(points.limit(0)).count() == 0 and keyframes.rebuild(log.limit(0)).count() == 0


def test_last_minute_of_an_hour_ends_without_a_row(spark):
    points = points_df(spark, [("2024-01-01 23:58", 1, 0.5), ("2024-01-01 23:59", 1, 0.5)])
    log = keyframes.key_frames(points)
    assert [r.kind for r in log.collect()] == ["key"] and rebuilt(log) == dense(points)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 260), st.integers(1, 3), st.sampled_from([0.0, 0.5, None])), min_size=1, max_size=40))
def test_any_feed_is_rebuilt(spark, entries):
    points = points_df(spark, [(f"2024-03-30 {22 + m // 60:02d}:{m % 60:02d}" if m < 120 else
                                f"2024-03-31 {(m - 120) // 60:02d}:{m % 60:02d}", s, v) for m, s, v in entries])
    assert rebuilt(keyframes.key_frames(points)) == dense(points)


def test_stored_log_prunes_other_days(spark, tmp_path):
    days = [(f"2024-01-0{d} {h:02d}:30", 1, 0.5) for d in (1, 2, 3) for h in (1, 2)]
    path, points = str(tmp_path / "log"), points_df(spark, days)
    keyframes.write_key_frames(keyframes.key_frames(points), path)
    back = keyframes.read_key_frames(spark, path)
    assert rebuilt(back) == dense(points)
    plan = keyframes.frame_at(back, "2024-01-02 01:40:00Z")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(frame_date" in plan and "frame_hour" in plan.split("PushedFilters")[1]
    assert keyframes.frame_at(back, "2024-01-02 01:40:00Z").count() == 1
