import datetime as dt

from stationflow.operators.repair import repair_window, touched_dates

from conftest import records_df, ts

S = "EN SERVICE"


def test_repair_replaces_closed_window(spark):
    r = records_df(spark, [
        (1, S, 1, 0, "2023-11-15 22:35:00"), (1, S, 2, 0, "2023-11-16 13:40:00"),  # source ends
        (1, S, 3, 0, "2023-11-16 13:40:01"),                                       # outside source
        (1, S, 9, 0, "2023-11-22 22:35:00"), (1, S, 9, 0, "2023-11-23 13:40:00"),  # dead, ends
        (1, S, 4, 0, "2023-11-23 13:41:00"), (1, S, 5, 0, None),                   # kept
    ])
    out = repair_window(r, "2023-11-22 22:35:00 UTC", "2023-11-23 13:40:00 UTC")
    got = sorted(((x.record_timestamp, x.nb_available_bikes, x.last_update) for x in out.collect()),
                 key=lambda t: (t[0] is None, t[0] or dt.datetime.min))
    assert [(g[0], g[1]) for g in got] == [
        (ts("2023-11-15 22:35:00"), 1), (ts("2023-11-16 13:40:00"), 2), (ts("2023-11-16 13:40:01"), 3),
        (ts("2023-11-22 22:35:00"), 1), (ts("2023-11-23 13:40:00"), 2), (ts("2023-11-23 13:41:00"), 4),
        (None, 5)]
    # last_update is not shifted
    assert got[3][2] == ts("2023-11-15 22:35:00")


def test_repair_with_empty_source_only_deletes(spark):
    r = records_df(spark, [(1, S, 9, 0, "2023-11-22 23:00:00"), (1, S, 4, 0, "2023-11-24 00:00:00")])
    out = repair_window(r, "2023-11-22 22:35:00 UTC", "2023-11-23 13:40:00 UTC")
    assert [x.nb_available_bikes for x in out.collect()] == [4]


def test_repair_outside_rows_unchanged(spark):
    data = [(k, S, k, 0, f"2023-11-{d:02d} 12:00:00") for k in range(3) for d in range(1, 29)]
    r = records_df(spark, data)
    out = repair_window(r, "2023-11-22 00:00:00 UTC", "2023-11-22 23:59:59 UTC")
    outside = "record_timestamp < timestamp'2023-11-22 00:00:00' or " \
              "record_timestamp > timestamp'2023-11-22 23:59:59'"
    assert r.where(outside).subtract(out).count() == 0      # rows outside survive unchanged
    assert out.where(outside).count() == r.where(outside).count()
    inside = out.where(f"not ({outside})").collect()        # the copy of the week before
    assert sorted(x.nb_available_bikes for x in inside) == [0, 1, 2]
    assert out.count() == r.count()
    assert touched_dates("2023-11-22 22:35:00 UTC", "2023-11-23 13:40:00 UTC") == \
        [dt.date(2023, 11, 22), dt.date(2023, 11, 23)]
