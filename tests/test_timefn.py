import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationflow.functions import codec, timefn


def test_span_today_at_half_past_midnight_local():
    # 00:30 Paris (winter, +1) = 23:30 UTC the day before
    now = dt.datetime(2024, 1, 15, 23, 30)
    assert timefn.span_bounds("today", now) == dt.datetime(2024, 1, 15, 23, 0)


def test_span_24h_and_7d():
    now = dt.datetime(2024, 1, 15, 12, 0)
    assert timefn.span_bounds("24h", now) == dt.datetime(2024, 1, 14, 12, 0)
    assert timefn.span_bounds("7d", now) == dt.datetime(2024, 1, 7, 23, 0)


def test_span_across_dst_change():
    # 2024-03-31: Paris goes from +1 to +2. Local midnight of that day is 23:00 UTC
    # on the 30th; local midnight of the next day is 22:00 UTC.
    now = dt.datetime(2024, 3, 31, 12, 0)
    assert timefn.span_bounds("today", now) == dt.datetime(2024, 3, 30, 23, 0)
    lo, hi = timefn.local_day_bounds(dt.date(2024, 3, 31))
    assert hi - lo == dt.timedelta(hours=23)
    lo, hi = timefn.local_day_bounds(dt.date(2024, 10, 27))
    assert hi - lo == dt.timedelta(hours=25)


def test_span_fixed_offset_compat():
    now = dt.datetime(2024, 1, 15, 12, 0)
    assert timefn.span_bounds("today", now, "+02:00") == dt.datetime(2024, 1, 14, 22, 0)


def test_unknown_span_raises():
    with pytest.raises(ValueError):
        timefn.span_bounds("month", dt.datetime(2024, 1, 1))


def test_weekday_index_sunday_is_one():
    assert timefn.weekday_index("Sunday") == 1
    assert timefn.weekday_index("Saturday") == 7
    with pytest.raises(ValueError):
        timefn.weekday_index("Funday")


def test_local_time_and_labels(spark):
    df = spark.createDataFrame([("2024-01-15T23:30:00Z",)], "t string") \
        .select(F.to_timestamp("t").alias("t"))
    r = df.select(
        timefn.local_time("t").cast("string").alias("paris"),
        timefn.local_time("t", "+02:00").cast("string").alias("fixed"),
        timefn.local_date("t").cast("string").alias("day"),
        timefn.minute_label("t").alias("label"),
        timefn.hhmm_label("t").alias("hhmm"),
        timefn.hhmm_display(timefn.hhmm_label("t")).alias("disp"),
        F.dayofweek("t").alias("dow"),
    ).first()
    assert r.paris == "2024-01-16 00:30:00"
    assert r.fixed == "2024-01-16 01:30:00"
    assert r.day == "2024-01-16"
    assert r.label == "2024-01-15 23:30"
    assert (r.hhmm, r.disp) == ("2330", "23:30")
    assert r.dow == 2  # Monday


def test_ts_literal_is_zone_independent(spark):
    v = spark.range(1).select(timefn.ts_literal("2023-11-22 22:35:00 UTC").cast("string")).first()[0]
    assert v == "2023-11-22 22:35:00"
    v = spark.range(1).select(timefn.ts_literal("2023-11-22T23:35:00+01:00").cast("string")).first()[0]
    assert v == "2023-11-22 22:35:00"


def test_axis_labels(spark):
    df = spark.createDataFrame([("2024-01-15 03:00:00",), ("2024-01-15 04:00:00",),
                                ("2024-01-15 00:00:00",), ("2024-01-15 03:01:00",)], "m string") \
        .select(F.col("m").cast("timestamp_ntz").alias("m"))
    got = [tuple(r) for r in df.select(timefn.axis_label("m", "today"),
                                       timefn.axis_label("m", "7d")).collect()]
    assert got == [("03h", None), (None, None), ("00h", "15/01"), (None, None)]
    with pytest.raises(ValueError):
        timefn.axis_label("m", "year")


def test_codec(spark):
    df = spark.createDataFrame([("gs://b/data___2023_09_27_10_00_00.json", "2023-09-27 10:00:00",
                                 "aGVsbG8=", '{"k": 7}')], "p string, n string, b string, j string")
    r = df.select(
        codec.file_basename("p").alias("base"),
        codec.capture_time_from_name("p").cast("string").alias("cap"),
        codec.sanitize_name("n").alias("clean"),
        codec.snapshot_file_name(F.col("n").cast("timestamp_ntz")).alias("name"),
        codec.decode_base64_text("b").alias("msg"),
        codec.json_field("j", "k").alias("k"),
    ).first()
    assert r.base == "data___2023_09_27_10_00_00.json"
    assert r.cap == "2023-09-27 08:00:00"  # local summer time → UTC
    assert r.clean == "2023_09_27 10_00_00"
    assert r.name == "data___2023_09_27_10_00_00.json"
    assert r.msg == "hello" and r.k == 7
