import json
import os

import pytest
from pyspark.sql import functions as F

from stationflow.operators import intervals, network
from stationflow.operators.flatten import flatten_snapshots
from stationflow.operators.timeaxis import minute_fill, minute_first
from stationflow.operators.transactions import transactions_by_hour
from stationflow.plans import lifecycle, rollups
from stationflow.sources import dated
from stationflow.sources.snapshots import read_snapshots
from stationflow.streaming.transactions import kept_transactions, transactions_stream

from conftest import records_df, rows
from test_flatten import _doc, _rec

S = "EN SERVICE"
TZ = "Europe/Paris"


def write(path, name, recs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"data___{name}.json"), "w") as f:
        f.write(json.dumps(_doc(recs)))


# Readings on both sides of local midnight, with a null count and equal times of two stations.
READINGS = [(1, 5, "2023-09-27T20:00:00Z"), (1, 3, "2023-09-27T21:59:00Z"), (1, 9, "2023-09-27T22:01:00Z"),
            (1, None, "2023-09-28T05:00:00Z"), (1, 4, "2023-09-28T06:00:00Z"), (1, 6, "2023-09-28T06:30:00Z"),
            (2, 5, "2023-09-27T20:00:00Z"), (2, 0, "2023-09-28T06:10:00Z"), (2, 7, "2023-09-28T06:20:00Z")]


@pytest.mark.parametrize("order", [1, -1, 4])
def test_streamed_counts_equal_the_batch_in_any_order(spark, tmp_path, order):
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")
    readings = READINGS[::order] if abs(order) == 1 else [READINGS[i * order % 9] for i in range(9)]
    for i, (station, bikes, at) in enumerate(readings):
        write(src, f"{i:02d}", [_rec(str(station), bikes=bikes, t=at)])
        if i in (3, 8):  # a restart in the middle
            q = transactions_stream(spark, src, str(tmp_path / "hours"), ckpt, TZ, available_now=True,
                                    max_files_per_trigger=2)
            q.awaitTermination(240)
    batch = transactions_by_hour(flatten_snapshots(read_snapshots(spark, src)), TZ, pad=False)
    want = rows(batch.select("local_date", "hour_of_day", "borrowed", "returned"), "local_date", "hour_of_day")
    got = kept_transactions(spark, str(tmp_path / "hours"))
    assert rows(got.select("local_date", "hour_of_day", "borrowed", "returned"), "local_date", "hour_of_day") == want
    assert want


def test_days_beyond_the_watermark_are_dropped_from_the_state(spark, tmp_path):
    src, ckpt, table = (str(tmp_path / n) for n in ("src", "ckpt", "hours"))

    def run():
        transactions_stream(spark, src, table, ckpt, TZ, lateness="1 day", available_now=True,
                            max_files_per_trigger=1).awaitTermination(240)
        return {(str(r.local_date), r.hour_of_day): r.borrowed for r in kept_transactions(spark, table).collect()}
    write(src, "0", [_rec("1", bikes=5, t="2023-09-01T08:00:00Z"), _rec("1", bikes=3, t="2023-09-01T09:00:00Z")])
    write(src, "1", [_rec("1", bikes=5, t="2023-09-09T08:00:00Z"), _rec("1", bikes=4, t="2023-09-09T09:00:00Z")])
    assert run() == {("2023-09-01", 11): 2, ("2023-09-09", 11): 1}
    write(src, "2", [_rec("1", bikes=1, t="2023-09-01T10:00:00Z"), _rec("1", bikes=1, t="2023-09-09T09:30:00Z")])
    assert run() == {("2023-09-01", 11): 2, ("2023-09-09", 11): 4}  # the first day is closed


def data(spark, days=range(1, 22)):
    return records_df(spark, [(k, S, (k * 7 + d * 3 + h) % 17 if (d + h) % 5 else None, 1, f"2024-01-{d:02d} {h:02d}:30:00")
                              for k in (1, 2, 3) for d in days for h in (0, 7, 23)])


def test_rollups_follow_loads_replacements_and_repairs(spark, tmp_path):
    fact, kept = str(tmp_path / "fact"), str(tmp_path / "kept")
    rollups.append_kept(data(spark, range(1, 10)), fact, kept)
    rollups.append_kept(data(spark, range(8, 22)), fact, kept)  # two days come twice
    rollups.append_kept(records_df(spark, [(1, S, 5, 5, None)]), fact, kept)
    fresh = data(spark, range(3, 6)).withColumn("nb_available_bikes", F.col("nb_available_bikes") + 50)
    rollups.replace_kept(spark, fresh, fact, kept, "2024-01-03 07:00:00 UTC", "2024-01-05 12:00:00 UTC")
    rollups.repair_kept(spark, fact, kept, "2024-01-15 07:00:00 UTC", "2024-01-16 08:00:00 UTC")
    table = dated.read(spark, fact)
    want = network.hourly_profile(table, "2024-01-01 00:00:00 UTC", "2024-02-01 00:00:00 UTC")
    keys = ["station_id", "day_of_week", "hour_of_day"]
    assert rows(rollups.kept_profile(spark, kept), *keys) == rows(want.select(*keys, "avg_nb_available_bikes"), *keys)
    totals = network.network_total(table).select("record_timestamp", "total_bikes", "readings")
    assert rows(rollups.kept_totals(spark, kept), "record_timestamp") == rows(totals, "record_timestamp")
    import datetime as dt
    part = rollups.kept_profile(spark, kept, dt.date(2024, 1, 4), dt.date(2024, 1, 16))
    want = network.hourly_profile(table, "2024-01-04 00:00:00 UTC", "2024-01-17 00:00:00 UTC")
    assert rows(part, *keys) == rows(want.select(*keys, "avg_nb_available_bikes"), *keys)


def test_ranges_say_what_the_dense_series_says(spark):
    r = records_df(spark, [(1, S, 4, 1, "2024-01-01 23:58:30"), (1, S, 6, 1, "2024-01-02 00:02:10"),
                           (1, S, None, 1, "2024-01-04 12:00:00"), (1, S, 9, 1, "2024-01-04 12:03:00"),
                           (2, S, 1, 1, "2024-01-02 05:00:00"), (2, S, 2, 1, "2024-01-02 05:00:30"), (3, S, 1, 1, None)])
    ranges = intervals.value_ranges(r, ["station_id"], ["nb_available_bikes"])
    first = minute_first(r, ["station_id"], "record_timestamp", ["nb_available_bikes"])
    dense = minute_fill(first, ["station_id"], ["nb_available_bikes"])
    exploded = intervals.minutes_between(ranges, "2024-01-01 00:00:00 UTC", "2024-01-05 00:00:00 UTC", ["station_id"],
                                         ["nb_available_bikes"])
    assert rows(exploded.select(*dense.columns), "station_id", "minute") == rows(dense, "station_id", "minute")
    looked_up = intervals.value_at(dense.select("station_id", F.col("minute").alias("at")), ranges, ["station_id"],
                                   ["nb_available_bikes"])
    assert rows(looked_up, "station_id", "at") == rows(dense, "station_id", "minute")
    days = ranges.where(F.to_date("valid_from") != F.to_date(F.col("valid_to") - F.expr("interval 1 second")))
    assert days.count() == 0
    outside = spark.sql("select bigint(1) station_id, timestamp'2023-12-31 00:00:00' at union all select 9, null")
    assert [x.nb_available_bikes for x in intervals.value_at(outside, ranges, ["station_id"],
                                                             ["nb_available_bikes"]).collect()] == [None, None]
    part = intervals.minutes_between(ranges, "2024-01-01 23:59:00 UTC", "2024-01-02 00:03:00 UTC", ["station_id"],
                                     ["nb_available_bikes"])
    assert [x.nb_available_bikes for x in part.orderBy("minute").collect()] == [4, 4, 4, 6]


@pytest.mark.parametrize("query", ["stream_transactions", "stream_transactions_out_of_order"])
def test_streamed_loads_keep_the_files_of_their_partitions(spark, tmp_path, monkeypatch, query):
    """A load isn't gathered into one file to be one batch."""
    src, work = str(tmp_path / "src"), str(tmp_path / "work")
    for i, (station, bikes, at) in enumerate(READINGS):
        write(src, f"{i:02d}", [_rec(str(station), bikes=bikes, t=at)])
    docs = read_snapshots(spark, src)
    docs = docs.withColumn("capture_minute", F.date_trunc("minute", F.col("records")[0]["record_timestamp"])).repartition(9)
    monkeypatch.setattr(lifecycle, "_snapshots", lambda spark, sf_dir: docs)
    monkeypatch.setattr(lifecycle, "_work", lambda spark, name: work)
    got = rows(lifecycle.QUERIES[query](spark, ""), "local_date", "hour_of_day")
    batch = transactions_by_hour(flatten_snapshots(docs), TZ, pad=False)
    want = rows(batch.select(F.col("local_date").cast("string"), "hour_of_day", "borrowed", "returned"), "local_date", "hour_of_day")
    assert got == want and want
    files = [f for f in os.listdir(f"{work}/raw") if f.startswith("part-")]
    assert len(files) > 3
