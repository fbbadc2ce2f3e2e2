import datetime as dt

from pyspark.sql import functions as F

from stationflow.operators.timeaxis import minute_fill, minute_first, pad_tail
from stationflow.plans import catalog
from stationflow.plans.dashboard import minute_timeline, station_day_timelines

from conftest import records_df, rows, ts


def _series(spark, data):
    """data: (key, ts_text, value)."""
    df = spark.createDataFrame([(k, t, v) for k, t, v in data], "k int, t string, v bigint")
    return df.select("k", F.to_timestamp(F.concat("t", F.lit("Z"))).alias("record_timestamp"), "v")


def test_minute_first_takes_first_non_null_in_time_order(spark):
    df = _series(spark, [(1, "2024-01-01 10:00:05", None), (1, "2024-01-01 10:00:30", 4),
                         (1, "2024-01-01 10:00:50", 9), (1, "2024-01-01 10:01:10", None)])
    got = rows(minute_first(df, ["k"], "record_timestamp", ["v"]), "minute")
    assert got == [(1, ts("2024-01-01 10:00"), 4), (1, ts("2024-01-01 10:01"), None)]


def test_minute_fill_carries_last_row_including_null(spark):
    df = _series(spark, [(1, "2024-01-01 10:00:00", 3), (1, "2024-01-01 10:03:00", None),
                         (1, "2024-01-01 10:05:00", 7), (2, "2024-01-01 10:00:00", 1)])
    first = minute_first(df, ["k"], "record_timestamp", ["v"])
    got = rows(minute_fill(first, ["k"], ["v"]), "k", "minute")
    m = lambda s: ts(f"2024-01-01 {s}")
    assert got == [(1, m("10:00"), 3), (1, m("10:01"), 3), (1, m("10:02"), 3),
                   (1, m("10:03"), None), (1, m("10:04"), None), (1, m("10:05"), 7),
                   (2, m("10:00"), 1)]


def test_minute_fill_across_midnight_and_idempotent(spark):
    df = _series(spark, [(1, "2024-01-01 23:58:00", 3), (1, "2024-01-02 00:02:00", 5)])
    first = minute_first(df, ["k"], "record_timestamp", ["v"])
    once = minute_fill(first, ["k"], ["v"])
    assert once.count() == 5
    twice = minute_fill(once, ["k"], ["v"])
    assert rows(once, "minute") == rows(twice, "minute")


def test_minute_fill_no_gaps(spark):
    df = _series(spark, [(1, f"2024-01-0{d} {h:02d}:{m:02d}:00", h) for d, h, m in
                         [(1, 1, 5), (1, 7, 0), (2, 3, 30), (4, 0, 0)]])
    filled = minute_fill(minute_first(df, ["k"], "record_timestamp", ["v"]), ["k"], ["v"])
    stats = filled.agg(F.count("*"), F.min("minute"), F.max("minute"),
                       F.count_distinct("minute")).first()
    span = (stats[2] - stats[1]) // dt.timedelta(minutes=1) + 1
    assert stats[0] == stats[3] == span


def test_pad_tail_lengths(spark):
    for n, expect in [(1, 1440), (1439, 1440), (1440, 1440), (1441, 1441)]:
        base = spark.range(n).select(F.lit(1).alias("k"),
                                     (F.to_timestamp(F.lit("2024-01-01T00:00:00Z"))
                                      + F.make_dt_interval(mins=F.col("id").cast("int")))
                                     .alias("minute"),
                                     F.col("id").alias("v"))
        out = pad_tail(base, ["k"], ["v"])
        assert out.count() == expect
        if n < 1440:
            last = out.agg(F.max("minute")).first()[0]
            assert last == ts("2024-01-01 00:00") + dt.timedelta(minutes=1439)
            assert out.where(F.col("v").isNull()).count() == 1440 - n
    empty = spark.createDataFrame([], "k int, minute timestamp, v bigint")
    assert pad_tail(empty, ["k"], ["v"]).count() == 0
    assert pad_tail(empty.drop("k"), [], ["v"]).count() == 0
    assert minute_fill(empty.drop("k"), [], ["v"], pad=1440).count() == 0


def test_readings_without_a_time_are_in_no_minute(spark):
    r = records_df(spark, [(7, "EN SERVICE", 3, 1, "2024-01-15 23:00:10"), (7, "EN SERVICE", 4, 1, None),
                           (8, "EN SERVICE", 4, 1, None)])
    got = minute_timeline(r, ["station_id"], "nb_available_bikes", "UTC", pad=2).orderBy("minute").collect()
    assert [(x.station_id, x.nb_available_bikes) for x in got] == [(7, 3), (7, None)]


def test_padding_in_the_fill_equals_pad_tail(spark):
    df = _series(spark, [(1, "2024-01-01 23:00:00", 3), (1, "2024-01-02 12:05:00", None),
                         (2, "2024-01-01 10:00:00", 1), (3, "2024-01-01 10:00:00", 1), (3, "2024-01-03 10:00:00", 2)])
    first = minute_first(df, ["k"], "record_timestamp", ["v"])
    apart = pad_tail(minute_fill(first, ["k"], ["v"]), ["k"], ["v"])
    assert sorted(map(str, minute_fill(first, ["k"], ["v"], pad=1440).collect())) == sorted(map(str, apart.collect()))


def test_minute_timeline_labels_local_time(spark):
    r = records_df(spark, [(7, "EN SERVICE", 3, 1, "2024-01-15 23:00:10")])
    t = minute_timeline(r, ["station_id"], "nb_available_bikes", "Europe/Paris", pad=3)
    got = rows(t.select(F.col("local_minute").cast("string"), "nb_available_bikes"),
               "local_minute")
    assert got == [("2024-01-16 00:00:00", 3), ("2024-01-16 00:01:00", None),
                   ("2024-01-16 00:02:00", None)]


def test_series_span_matches_filled_count(spark):
    from stationflow.operators.timeaxis import series_span
    df = _series(spark, [(1, "2024-01-01 10:00:00", 3), (1, "2024-01-01 12:05:00", 4),
                         (2, "2024-01-01 10:00:00", 1)])
    first = minute_first(df, ["k"], "record_timestamp", ["v"])
    filled = minute_fill(first, ["k"], ["v"])
    counted = {r.k: r[1] for r in filled.groupBy("k").count().collect()}
    spans = {r["k"]: r["__n"] for r in series_span(first, ["k"]).collect()}
    assert counted == spans == {1: 126, 2: 1}
    a = pad_tail(filled, ["k"], ["v"], span=series_span(first, ["k"]))
    b = pad_tail(filled, ["k"], ["v"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_local_labels_across_dst_change(spark):
    # Gap across the autumn change (Paris 03:00 CEST → 02:00 CET on 2024-10-27).
    df = _series(spark, [(1, "2024-10-27 00:30:00", 1), (1, "2024-10-27 01:30:00", 2),
                         (2, "2024-01-10 10:00:00", 3), (2, "2024-01-10 11:00:00", 4)])
    first = minute_first(df, ["k"], "record_timestamp", ["v"])
    filled = minute_fill(first, ["k"], ["v"], label="lm", tz="Europe/Paris")
    padded = pad_tail(filled, ["k"], ["v"], length=200, label="lm", tz="Europe/Paris")
    exp = padded.select("lm", F.from_utc_timestamp("minute", "Europe/Paris")
                        .cast("timestamp_ntz").alias("e"))
    assert exp.where(F.col("lm") != F.col("e")).count() == 0
    assert padded.count() == 400
    labels = [r.lm for r in padded.where("k = 1").orderBy("minute").collect()]
    assert labels[29] == ts("2024-10-27 02:59") and labels[30] == ts("2024-10-27 02:00")


def test_minute_timeline_matches_pandas_resample(spark):
    """Brute force: first non-null per minute, then resample('1min').ffill()."""
    import random

    import pandas as pd
    rnd = random.Random(5)
    data = []
    for k in range(3):
        t = pd.Timestamp("2024-01-01 08:00:00")
        for _ in range(25):
            t += pd.Timedelta(seconds=rnd.choice([5, 20, 50, 130, 600, 3700]))
            data.append((k, t.strftime("%Y-%m-%d %H:%M:%S"), rnd.choice([None, rnd.randrange(30)])))
    r = records_df(spark, [(k, "EN SERVICE", v, 0, t) for k, t, v in data])
    got = minute_timeline(r, ["station_id"], "nb_available_bikes", "UTC", pad=None).toPandas()
    for k in range(3):
        p = pd.DataFrame([(pd.Timestamp(t), v) for kk, t, v in data if kk == k], columns=["t", "v"])
        p["v"] = p["v"].astype("float")
        p.index = p["t"].dt.floor("min")
        exp = p.groupby(level=0)["v"].first().resample("1min").ffill()
        mine = got[got.station_id == k].set_index("minute")["nb_available_bikes"].astype("float")
        mine.index = pd.to_datetime(mine.index).tz_localize(None)
        assert list(mine.index) == list(exp.index)
        assert mine.fillna(-1).tolist() == exp.fillna(-1).tolist()


def test_day_text_is_made_of_readings_not_of_minutes(spark):
    r = records_df(spark, [(7, "EN SERVICE", 3, 1, "2024-01-15 22:59:10"), (7, "EN SERVICE", None, 1, "2024-01-15 23:00:10"),
                           (7, "EN SERVICE", 5, 1, "2024-01-15 23:02:00"), (8, "EN SERVICE", 4, 1, None)])
    text = station_day_timelines(r, "Europe/Paris", 4, "yyyy-MM-dd")
    plan = text._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" in plan and "date_format" not in plan[:plan.index("Generate explode(sequence")]
    want = station_day_timelines(r, "Europe/Paris", 4).withColumn("local_date", F.col("local_date").cast("string"))
    assert rows(text, "minute", "local_date") == rows(want, "minute", "local_date")
    assert [(x.local_date, x.nb_available_bikes) for x in text.orderBy("local_date", "minute").collect()] == [
        ("2024-01-15", 3), *[("2024-01-15", None)] * 3, ("2024-01-16", None), ("2024-01-16", None), ("2024-01-16", 5),
        ("2024-01-16", None)]


def test_registered_day_timeline_formats_no_minute(spark, monkeypatch):
    r = records_df(spark, [(7, "EN SERVICE", 3, 1, "2024-01-15 22:59:10")])
    monkeypatch.setattr(catalog, "_records", lambda spark, sf_dir: r)
    q = catalog.q_station_day_timeline(spark, "")
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" not in plan[:plan.index("Generate explode(sequence")]
    assert q.columns == ["station_id", "local_date", "minute", "nb_available_bikes"] and q.count() == 1440


def test_minutes_come_from_the_generator_as_they_are(spark):
    df = _series(spark, [(1, "2024-01-01 10:00:00", 3), (1, "2024-01-01 10:03:00", None)])
    filled = minute_fill(minute_first(df, ["k"], "record_timestamp", ["v"]), ["k"], ["v"])
    top = filled._jdf.queryExecution().optimizedPlan().toString().split("Generate explode(sequence")[0]
    assert "*" not in top and "CASE" not in top
    assert [r.v for r in filled.orderBy("minute").collect()] == [3, 3, 3, None]
