"""The dimension with history: ranges, loads in any order, joins as of a day."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from stationflow.operators.flatten import latest_per_key
from stationflow.plans import history
from stationflow.schemas import STATION_COLUMNS
from tests.conftest import records_df, rows

SCHEMA = ("id bigint, name string, adress string, city string, type string, latitude double, longitude double, "
          "record_timestamp string, last_update string, extra int")


def seen(spark, *described):
    """(id, name, city, time text[, last update text])"""
    data = [(d[0], d[1], None, d[2], "t", 1.0, 2.0, d[3], d[4] if len(d) > 4 else d[3], 7) for d in described]
    df = spark.createDataFrame(data, SCHEMA)
    return df.withColumns({c: F.to_timestamp(F.concat(c, F.lit("Z"))) for c in ("record_timestamp", "last_update")})


OBSERVED = [(1, "A", "x", "2024-01-01 08:00:00"), (1, "A", "x", "2024-01-02 08:00:00"), (1, "B", "x", "2024-01-03 08:00:00"),
            (1, "A", "x", "2024-01-03 09:00:00"), (1, "B", "x", "2024-01-05 23:30:00"), (1, None, "x", "2024-01-08 12:00:00"),
            (2, None, None, "2024-01-02 08:00:00"), (None, "Z", "z", "2024-01-02 08:00:00"), (3, "C", "y", None)]
RANGES = [(1, "A", dt.date(2024, 1, 1), dt.date(2024, 1, 6)), (1, "B", dt.date(2024, 1, 6), dt.date(2024, 1, 8)),
          (1, None, dt.date(2024, 1, 8), None), (2, None, dt.date(2024, 1, 2), None)]


def short(ranges):
    return rows(ranges.select("id", "name", "valid_from", "valid_to"), "id", "valid_from")


def test_ranges_of_local_days(spark):
    """Back to an old name within a day is no change; 23:30 UTC is the next day in Paris."""
    ranges = history.description_ranges(history.daily_descriptions(seen(spark, *OBSERVED)))
    assert short(ranges) == RANGES
    assert ranges.columns == [*STATION_COLUMNS, "valid_from", "valid_to"]


def test_loads_in_any_order_and_twice(spark, tmp_path):
    parts = [OBSERVED[:3], OBSERVED[2:5], OBSERVED[5:]]
    for n, order in enumerate(itertools.permutations(range(3))):
        path = str(tmp_path / str(n))
        for i in [*order, order[0]]:
            history.append_descriptions(seen(spark, *parts[i]), path)
        assert short(history.description_ranges(history.kept_descriptions(spark, path))) == RANGES


def test_load_that_is_repeated_under_its_name_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "kept")
    for _ in range(2):
        history.append_descriptions(seen(spark, *OBSERVED), path, name="load-1")
    assert history.kept_descriptions(spark, path).count() == 6


def test_equal_times_have_one_result(spark):
    tied = [(1, n, "x", "2024-01-01 08:00:00") for n in ("B", "C", "A", None)]
    for order in itertools.permutations(tied):
        assert history.daily_descriptions(seen(spark, *order).repartition(4)).first()["name"] == "C"
    late = [(1, "A", "x", "2024-01-01 08:00:00", "2024-01-01 07:59:00"), (1, "B", "x", "2024-01-01 08:00:00", "2024-01-01 07:00:00")]
    assert history.daily_descriptions(seen(spark, *late)).first()["name"] == "A"


def test_readings_get_the_name_of_their_day(spark):
    ranges = history.description_ranges(history.daily_descriptions(seen(spark, *OBSERVED)))
    readings = [(s, "EN SERVICE", 1, 1, t) for s, t in [
        (1, "2023-12-31 12:00:00"), (1, "2024-01-05 22:59:00"), (1, "2024-01-05 23:00:00"), (1, "2024-01-05 23:00:00"),
        (1, "2024-01-09 00:00:00"), (9, "2024-01-05 12:00:00"), (None, "2024-01-05 12:00:00"), (1, None)]]
    got = history.join_as_of(records_df(spark, readings), ranges, ["name", "city"])
    names = sorted(((r.station_id, r.record_timestamp, r["name"], r.city) for r in got.collect()), key=str)
    assert len(names) == len(readings)
    assert [n for s, t, n, c in names if s == 1 and t is not None] == [None, "A", "B", "B", None]
    assert all(n is None and c is None for s, t, n, c in names if s != 1 or t is None)


def test_latest_slice_is_the_latest_dimension(spark):
    rows_ = seen(spark, *OBSERVED).where("id is not null and record_timestamp is not null")
    want = latest_per_key(rows_, "id", ["record_timestamp", "last_update"], STATION_COLUMNS).select(*STATION_COLUMNS)
    got = history.current(history.description_ranges(history.daily_descriptions(rows_)))
    assert rows(got, "id") == rows(want, "id")
    assert history.description_ranges(history.daily_descriptions(rows_.limit(0))).count() == 0
