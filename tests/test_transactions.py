import datetime as dt

from pyspark.sql import functions as F

from stationflow.operators.transactions import loans_total, station_deltas, transactions_by_hour

from conftest import records_df, rows

S = "EN SERVICE"
DAY = dt.date(2024, 1, 15)


def test_single_reading_unchanged_and_null_counts(spark):
    r = records_df(spark, [
        (1, S, 5, 0, "2024-01-15 08:00:00"),                      # alone: no delta
        (2, S, 5, 0, "2024-01-15 08:00:00"), (2, S, 5, 0, "2024-01-15 08:01:00"),  # unchanged
        (3, S, 5, 0, "2024-01-15 08:00:00"), (3, S, None, 0, "2024-01-15 08:01:00"),
        (3, S, 2, 0, "2024-01-15 08:02:00"),                      # null in between
    ])
    assert station_deltas(r, "UTC").count() == 0


def test_borrowed_positive_returned_negative(spark):
    r = records_df(spark, [(1, S, 10, 0, "2024-01-15 08:00:00"), (1, S, 7, 0, "2024-01-15 08:10:00"),
                           (1, S, 9, 0, "2024-01-15 09:10:00")])
    t = transactions_by_hour(r, "UTC", DAY, pad=False)
    assert rows(t, "hour_of_day") == [(DAY, 8, 3, 0), (DAY, 9, 0, 2)]
    assert rows(loans_total(r, "UTC", DAY)) == [(DAY, 3)]


def test_midnight_not_counted_and_local_day(spark):
    # 22:59 UTC on the 14th is 23:59 in Paris: a different local day than 23:01 UTC.
    r = records_df(spark, [(1, S, 10, 0, "2024-01-14 22:59:00"), (1, S, 4, 0, "2024-01-14 23:01:00"),
                           (1, S, 1, 0, "2024-01-14 23:30:00")])
    t = transactions_by_hour(r, "Europe/Paris", DAY, pad=False)
    assert rows(t) == [(DAY, 0, 3, 0)]
    t = transactions_by_hour(r, "UTC", dt.date(2024, 1, 14), pad=False)
    assert rows(t, "hour_of_day") == [(dt.date(2024, 1, 14), 23, 9, 0)]


def test_padding_fills_inner_hours(spark):
    r = records_df(spark, [(1, S, 10, 0, "2024-01-15 01:00:00"), (1, S, 7, 0, "2024-01-15 01:10:00"),
                           (1, S, 9, 0, "2024-01-15 05:10:00")])
    t = transactions_by_hour(r, "UTC", DAY, pad=True)
    got = rows(t, "hour_of_day")
    assert [g[1] for g in got] == list(range(24))
    assert got[1] == (DAY, 1, 3, 0) and got[5] == (DAY, 5, 0, 2) and got[3] == (DAY, 3, 0, 0)
    empty = transactions_by_hour(r.limit(0), "UTC", DAY, pad=True)
    assert empty.count() == 24


def test_equal_timestamps_are_ordered_by_last_update(spark):
    df = spark.createDataFrame(
        [(1, S, 5, 0, "C", "2024-01-15T08:00:00Z", "2024-01-15T08:00:00Z"),
         (1, S, 3, 0, "C", "2024-01-15T08:00:05Z", "2024-01-15T08:00:00Z")],
        "station_id bigint, operational_state string, nb_available_bikes bigint, "
        "nb_available_places bigint, connexion string, last_update string, record_timestamp string")
    df = df.select(*[F.to_timestamp(c).alias(c) if c in ("last_update", "record_timestamp")
                     else F.col(c) for c in df.columns])
    assert [r.transaction_value for r in station_deltas(df, "UTC").collect()] == [2]


def test_invariant_first_minus_last(spark):
    import random
    rnd = random.Random(3)
    data = []
    for sid in range(4):
        for i in range(60):
            data.append((sid, S, rnd.randrange(20), 0, f"2024-01-15 {i // 6:02d}:{(i % 6) * 10:02d}:00"))
    r = records_df(spark, data)
    d = station_deltas(r, "UTC").groupBy("station_id").agg(F.sum("transaction_value").alias("s"))
    firsts = {}
    for sid, _, b, _, t in sorted(data, key=lambda x: (x[0], x[4])):
        firsts.setdefault(sid, b)
        firsts[sid, "last"] = b
    for sid, s in d.collect():
        assert s == firsts[sid] - firsts[sid, "last"]
