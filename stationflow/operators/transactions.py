"""Borrow/return counts from consecutive readings of a station."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions.timefn import DEFAULT_TZ, local_day_bounds, local_time
from stationflow.operators.filters import time_range
from stationflow.operators.timeaxis import hour_axis


def _day_filter(records: DataFrame, day: dt.date | None, tz: str) -> DataFrame:
    if day is None:
        return records
    lo, hi = local_day_bounds(day, tz)  # UTC range: pushes down, DST-correct
    return time_range(records, lo, hi)


def _with_deltas(records: DataFrame, tz: str, day: dt.date | None) -> DataFrame:
    """Readings with their local day and hour and the change from the previous reading
    of the station on that day (``previous − current``; null where there is none).

    The window's groups are one station's readings of one day, so no key can be hotter
    than that."""
    along = Window.partitionBy("station_id", "local_date").orderBy("record_timestamp", "last_update")
    delta = F.lag("nb_available_bikes").over(along) - F.col("nb_available_bikes")
    return (_day_filter(records, day, tz)
            .where(F.col("station_id").isNotNull() & F.col("record_timestamp").isNotNull())
            .select("station_id", "record_timestamp", "last_update", "nb_available_bikes",
                    local_time("record_timestamp", tz).alias("local_ts"))
            .withColumn("local_date", F.to_date("local_ts"))
            .select("station_id", "record_timestamp", "local_date", F.hour("local_ts").alias("hour_of_day"),
                    delta.alias("transaction_value")))


def station_deltas(records: DataFrame, tz: str = DEFAULT_TZ,
                   day: dt.date | None = None) -> DataFrame:
    """Non-zero changes between consecutive readings of a station within a local day.

    ``transaction_value = previous − current``: positive means bikes left the
    station (borrowed). The previous reading is taken inside the same local day
    only, so the first reading of a day has none and the change across midnight is
    not counted. Readings without a previous value, or with a null count, yield
    nothing.
    """
    return _with_deltas(records, tz, day).where("transaction_value <> 0")


def transactions_by_hour(records: DataFrame, tz: str = DEFAULT_TZ,
                         day: dt.date | None = None, pad: bool = True) -> DataFrame:
    """Bikes borrowed and returned per local day and hour.

    ``borrowed`` sums positive changes, ``returned`` the negated negative ones.
    With ``pad`` every day gets all hours 0..23 (zero where nothing happened);
    the days are ``day`` when given (then ordered by hour), else every local day with
    a reading of a known station.
    """
    v = F.col("transaction_value")
    hourly = _with_deltas(records, tz, day).groupBy("local_date", "hour_of_day").agg(
        F.sum(F.when(v > 0, v).otherwise(0)).alias("borrowed"),
        F.sum(F.when(v < 0, -v).otherwise(0)).alias("returned"))
    if not pad:
        return hourly.where("borrowed > 0 or returned > 0")
    zero = F.lit(0).cast("bigint")
    if day is not None:
        axis = hour_axis(records.sparkSession.range(1).select(F.lit(day).alias("local_date")), ["local_date"])
        return (axis.join(hourly, ["local_date", "hour_of_day"], "left")
                .select("local_date", "hour_of_day", F.coalesce("borrowed", zero).alias("borrowed"),
                        F.coalesce("returned", zero).alias("returned")).orderBy("hour_of_day"))
    # The days come from the same pass: at most 24 hours each, kept as a map.
    days = hourly.groupBy("local_date").agg(F.map_from_entries(F.collect_list(F.struct(
        "hour_of_day", F.struct("borrowed", "returned")))).alias("__hours"))
    at = F.try_element_at("__hours", F.col("hour_of_day"))
    return (days.select("local_date", "__hours", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour_of_day"))
            .select("local_date", "hour_of_day", F.coalesce(at["borrowed"], zero).alias("borrowed"),
                    F.coalesce(at["returned"], zero).alias("returned")))


def loans_total(records: DataFrame, tz: str = DEFAULT_TZ,
                day: dt.date | None = None) -> DataFrame:
    """Bikes borrowed per local day (the day's loan count)."""
    return (transactions_by_hour(records, tz, day, pad=False)
            .groupBy("local_date").agg(F.sum("borrowed").alias("loans")))
