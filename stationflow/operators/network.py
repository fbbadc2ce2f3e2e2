"""Network-wide and per-station aggregations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.timefn import local_time, weekday_index
from stationflow.operators.filters import time_range
from stationflow.operators.joins import join_stations
from stationflow.schemas import STATE_IN_SERVICE, STATE_MAINTENANCE, STATE_REFORMED


def network_total(records: DataFrame, grain: str | None = None) -> DataFrame:
    """Bikes in the whole network per snapshot time.

    ``grain=None`` groups by the exact ``record_timestamp`` (all stations of one
    snapshot share it); ``grain="minute"`` groups by the truncated minute.
    """
    ts = F.col("record_timestamp")
    key = ts if grain is None else F.date_trunc(grain, ts)
    return (records.where(ts.isNotNull()).groupBy(key.alias("record_timestamp"))
            .agg(F.sum("nb_available_bikes").alias("total_bikes"),
                 F.count(F.lit(1)).alias("readings")))


def in_band(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """HAVING lo < col < hi (both bounds exclusive)."""
    return df.where((F.col(col) > lo) & (F.col(col) < hi))


def network_kpis(realtime: DataFrame) -> DataFrame:
    """The nine headline measures over one reading per station."""
    bikes, places = F.col("nb_available_bikes"), F.col("nb_available_places")
    state = F.col("operational_state")
    in_service = state == STATE_IN_SERVICE
    return realtime.agg(
        F.sum(bikes).alias("nb_available_bikes"),
        F.sum(places).alias("nb_available_places"),
        F.count_if((bikes == 0) & in_service).alias("nb_empty_stations"),
        F.count_if((places == 0) & in_service).alias("nb_full_stations"),
        F.count_if((bikes > 0) & in_service).alias("nb_stations_w_n_bikes_greater_than_zero"),
        F.count_if((places > 0) & in_service).alias("nb_stations_w_n_places_greater_than_zero"),
        F.count_if(in_service).alias("nb_stations_in_service"),
        F.count_if(state == STATE_MAINTENANCE).alias("nb_stations_in_maintenance"),
        F.count_if(state == STATE_REFORMED).alias("nb_stations_reformed"),
    )


def latest_readings(records: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """Latest reading per station (optionally as of an instant, exclusive)."""
    from stationflow.operators.flatten import latest_per_key
    r = records.where(F.col("station_id").isNotNull() & F.col("record_timestamp").isNotNull())
    if as_of is not None:
        r = time_range(r, None, as_of)
    return latest_per_key(r, "station_id", ["record_timestamp", "last_update"])


def hourly_profile(records: DataFrame, start: dt.datetime | str, end: dt.datetime | str,
                   station: int | None = None, weekday: str | int | None = None,
                   tz: str = "UTC") -> DataFrame:
    """Mean available bikes per station, weekday (Sunday = 1) and hour.

    Readings in ``[start, end)``; hour and weekday are taken in ``tz`` (UTC by
    default, as the warehouse query did). ``station``/``weekday`` narrow the
    result to one chart (both: ordered by hour); hours without data are absent.
    """
    ts = F.col("record_timestamp")
    r = time_range(records, start, end)
    if station is not None:
        r = r.where(F.col("station_id") == F.lit(station))
    t = ts if tz == "UTC" else local_time(ts, tz)
    r = r.select("station_id", "nb_available_bikes",
                 F.dayofweek(t).alias("day_of_week"), F.hour(t).alias("hour_of_day"))
    if weekday is not None:
        idx = weekday if isinstance(weekday, int) else weekday_index(weekday)
        r = r.where(F.col("day_of_week") == idx)
    out = (r.groupBy("station_id", "day_of_week", "hour_of_day")
           .agg(F.avg("nb_available_bikes").alias("avg_nb_available_bikes")))
    return out.orderBy("hour_of_day") if station is not None and weekday is not None else out


def empty_station_events(records: DataFrame, stations: DataFrame,
                         start: dt.datetime | str, end: dt.datetime | str) -> DataFrame:
    """In-service readings with no bike in ``[start, end)``, with the station name,
    ordered by time then name."""
    r = time_range(records, start, end).where(
        (F.col("nb_available_bikes") == 0) & (F.col("operational_state") == STATE_IN_SERVICE))
    return (join_stations(r.select("station_id", "record_timestamp"),
                          stations.select("id", "name"))
            .select("record_timestamp", "station_id", "name")
            .orderBy("record_timestamp", "name"))
