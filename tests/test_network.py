import datetime as dt

from pyspark.sql import functions as F

from stationflow.functions.status import availability_ratio, station_status
from stationflow.operators import network
from stationflow.operators.joins import join_stations
from stationflow.plans.dashboard import chart_series, index_kpis, network_timeline

from conftest import records_df, rows

S, M, R = "EN SERVICE", "IN_MAINTENANCE", "RÉFORMÉ"


def test_status_rules(spark):
    r = records_df(spark, [(1, R, 0, 0, "2024-01-01 00:00:00"), (2, M, 0, 3, "2024-01-01 00:00:00"),
                           (3, S, 0, 0, "2024-01-01 00:00:00"), (4, S, 1, 0, "2024-01-01 00:00:00"),
                           (5, S, 4, 2, "2024-01-01 00:00:00"), (6, S, 5, 0, "2024-01-01 00:00:00"),
                           (7, S, 5, 2, "2024-01-01 00:00:00"), (8, S, 0, 0, "2024-01-01 00:00:00")])
    got = rows(r.select("station_id", station_status().alias("s"),
                        availability_ratio().alias("ratio")), "station_id")
    assert [g[1] for g in got] == ["reformed", "maintenance", "empty", "low", "low", "full", "ok",
                                   "empty"]
    assert got[0][2] is None and got[3][2] == 1.0


def test_kpis(spark):
    r = records_df(spark, [(1, M, 0, 3, "2024-01-01 00:00:00"),     # out of service, 0 bikes
                           (2, S, 0, 0, "2024-01-01 00:00:00"),     # empty and full
                           (3, S, 4, 2, "2024-01-01 00:00:00"), (4, R, 2, 2, "2024-01-01 00:00:00")])
    k = network.network_kpis(r).first().asDict()
    assert k == {"nb_available_bikes": 6, "nb_available_places": 7, "nb_empty_stations": 1,
                 "nb_full_stations": 1, "nb_stations_w_n_bikes_greater_than_zero": 1,
                 "nb_stations_w_n_places_greater_than_zero": 1, "nb_stations_in_service": 2,
                 "nb_stations_in_maintenance": 1, "nb_stations_reformed": 1}


def test_index_kpis_latest_and_loans(spark):
    r = records_df(spark, [(1, S, 9, 1, "2024-01-15 08:00:00"), (1, S, 6, 4, "2024-01-15 09:00:00"),
                           (1, S, 1, 9, "2024-01-15 20:00:00")])
    k = index_kpis(r, dt.datetime(2024, 1, 15, 12, 0), "UTC").first()
    assert k.nb_available_bikes == 6 and k.todays_loan_count == 3  # readings after now excluded
    kept = records_df(spark, [(1, S, 6, 4, "2024-01-15 09:00:00"), (2, S, 5, 1, "2023-12-01 09:00:00")])
    k = index_kpis(r, dt.datetime(2024, 1, 15, 12, 0), "UTC", latest=kept).first()
    assert k.nb_available_bikes == 11 and k.todays_loan_count == 3


def test_band_is_exclusive(spark):
    r = records_df(spark, [(1, S, 1500, 0, "2024-01-01 00:00:00"), (1, S, 2300, 0, "2024-01-01 00:01:00"),
                           (1, S, 1501, 0, "2024-01-01 00:02:00")])
    t = network.in_band(network.network_total(r), "total_bikes", 1500, 2300)
    assert [x.total_bikes for x in t.collect()] == [1501]


def test_network_total_per_snapshot(spark):
    r = records_df(spark, [(1, S, 3, 0, "2024-01-01 00:00:00"), (2, S, 4, 0, "2024-01-01 00:00:00"),
                           (1, S, 5, 0, "2024-01-01 00:00:30")])
    assert sorted(x.total_bikes for x in network.network_total(r).collect()) == [5, 7]
    assert [x.total_bikes for x in network.network_total(r, "minute").collect()] == [12]


def test_hourly_profile(spark):
    # 2024-01-14 is a Sunday (index 1); the 16th is excluded by the end bound.
    r = records_df(spark, [(1, S, 2, 0, "2024-01-14 08:10:00"), (1, S, 4, 0, "2024-01-14 08:50:00"),
                           (1, S, 9, 0, "2024-01-15 08:10:00"), (2, S, 1, 0, "2024-01-14 08:10:00"),
                           (1, S, 7, 0, "2024-01-16 08:10:00")])
    p = network.hourly_profile(r, "2024-01-01 00:00:00 UTC", dt.datetime(2024, 1, 16),
                               station=1, weekday="Sunday")
    assert rows(p) == [(1, 1, 8, 3.0)]


def test_empty_station_events_and_join(spark):
    r = records_df(spark, [(1, S, 0, 3, "2024-01-01 00:01:00"), (2, S, 0, 3, "2024-01-01 00:00:00"),
                           (1, M, 0, 3, "2024-01-01 00:00:00"), (3, S, 1, 3, "2024-01-01 00:00:00")])
    st = spark.createDataFrame([(1, "B"), (2, "A"), (3, "C")], "id bigint, name string")
    ev = network.empty_station_events(r, st, "2024-01-01 00:00:00 UTC", "2024-01-02 00:00:00 UTC")
    assert [x.name for x in ev.collect()] == ["A", "B"]
    assert join_stations(r, st).count() == 4


def test_network_timeline_and_chart_series(spark):
    r = records_df(spark, [(1, S, 3, 0, "2024-01-01 10:00:00"), (2, S, 4, 0, "2024-01-01 10:00:00"),
                           (1, S, 5, 0, "2024-01-01 10:03:00")])
    t = network_timeline(r, span="today", now=dt.datetime(2024, 1, 1, 12, 0), tz="UTC",
                         band=None, pad=None)
    assert [x.total_bikes for x in t.orderBy("minute").collect()] == [7, 7, 7, 5]
    packed = chart_series(t.withColumn("k", F.lit(1)), ["k"], "minute", "local_minute",
                          ["total_bikes"]).first()
    assert packed["values"] == [7, 7, 7, 5] and len(packed["labels"]) == 4


def test_station_timeline_spans(spark):
    from stationflow.plans.dashboard import station_timeline
    r = records_df(spark, [(7, S, 1, 0, "2024-01-10 08:00:00"), (7, S, 2, 0, "2024-01-14 22:00:00"),
                           (7, S, 3, 0, "2024-01-15 08:00:00"), (8, S, 9, 0, "2024-01-15 08:00:00")])
    now = dt.datetime(2024, 1, 15, 12, 0)
    today = station_timeline(r, 7, "today", now, "Europe/Paris")
    assert today.count() == 1440                       # 23:00 UTC .. padded
    assert today.orderBy("minute").first().nb_available_bikes == 3  # 22:00 UTC is before local midnight
    last24 = station_timeline(r, 7, "24h", now, "Europe/Paris", pad=None)
    assert last24.count() == 601 and last24.agg(F.max("nb_available_bikes")).first()[0] == 3
    week = station_timeline(r, 7, "7d", now, "Europe/Paris", pad=None)
    assert week.orderBy("minute").first().nb_available_bikes == 1
