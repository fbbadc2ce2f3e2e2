"""Per-minute frame datasets for map animation and the time-lapse map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.status import availability_ratio
from stationflow.functions.timefn import (DEFAULT_TZ, hhmm_label, local_time, minute_label,
                                          one_minute)
from stationflow.operators.filters import time_range
from stationflow.operators.joins import join_stations
from stationflow.operators.sequential import with_next_minute
from stationflow.schemas import STATE_IN_SERVICE


def frame_points(records: DataFrame, stations: DataFrame, start=None, end=None,
                 tz: str = DEFAULT_TZ) -> DataFrame:
    """In-service readings in ``[start, end)`` with coordinates and the share of
    docks holding a bike, keyed by UTC minute, with its wall-clock label in ``tz``."""
    ts = F.col("record_timestamp")
    r = time_range(records, start, end).where(F.col("operational_state") == STATE_IN_SERVICE)
    j = join_stations(r, stations)
    minute = F.date_trunc("minute", ts)
    return j.where(ts.isNotNull()).select(
        minute.alias("minute"), local_time(minute, tz).alias("local_minute"),
        F.col("station_id"), ts.alias("record_timestamp"),
        F.col("latitude"), F.col("longitude"),
        availability_ratio().alias("taux_velos_dispo"))


def frame_entries(points: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Frames in long form: for every minute from the first to the last observed
    one, the entries of the latest observed minute (a minute without readings
    repeats the previous frame).

    Frames are instants: keys, steps and joins are UTC minutes, so each clock change has
    as many frames as minutes that pass. ``local_minute`` only labels them. No frame is
    ever one array until the sink asks for it: each entry is repeated over its minute
    range with ``explode(sequence)``.
    """
    nxt = with_next_minute(points.select("minute").distinct(), [], [], "minute")
    last = F.coalesce(F.col("__next") - one_minute(), F.col("minute"))
    spans = nxt.select(F.col("minute").alias("observed_minute"), last.alias("__last"))
    joined = points.join(spans, points["minute"] == spans["observed_minute"])
    frames = joined.select(
        F.explode(F.sequence(F.col("observed_minute"), F.col("__last"), one_minute()))
        .alias("minute"),
        "observed_minute", "station_id", "record_timestamp", "latitude", "longitude",
        "taux_velos_dispo")
    return frames.select("minute", local_time("minute", tz).alias("local_minute"), *frames.columns[1:])


def pack_frames(entries: DataFrame) -> DataFrame:
    """One row per minute with parallel arrays sorted by (time, station):
    ``minute`` text (the wall clock; the hour that an autumn change repeats has every
    label twice), ``latitude[]``, ``longitude[]``, ``taux_velos_dispo[]``."""
    items = F.array_sort(F.collect_list(F.struct(
        "record_timestamp", "station_id", "latitude", "longitude", "taux_velos_dispo")))
    g = entries.groupBy("minute", "local_minute").agg(items.alias("__items"))
    return g.select(
        minute_label("local_minute").alias("minute"),
        F.transform("__items", lambda x: x["latitude"]).alias("latitude"),
        F.transform("__items", lambda x: x["longitude"]).alias("longitude"),
        F.transform("__items", lambda x: x["taux_velos_dispo"]).alias("taux_velos_dispo"))


def animation_frames(records: DataFrame, stations: DataFrame, start=None, end=None,
                     tz: str = DEFAULT_TZ) -> DataFrame:
    """Minute-filled map frames (packed) for ``[start, end)``."""
    return pack_frames(frame_entries(frame_points(records, stations, start, end, tz), tz))


def timemap_rows(records: DataFrame, stations: DataFrame) -> DataFrame:
    """The time-lapse CSV rows: time, coordinates, bikes and ratio."""
    j = join_stations(records, stations)
    return j.select("record_timestamp", "latitude", "longitude",
                    F.col("nb_available_bikes").cast("int").alias("nb_velos_dispo"),
                    availability_ratio().alias("ratio"))


def timemap_frames(rows: DataFrame) -> DataFrame:
    """Rows with any null dropped, keyed by ``HHmm`` ``time_index``; rows whose
    ratio is null or NaN are not drawn."""
    clean = rows.na.drop("any")
    keyed = clean.withColumn("time_index", hhmm_label("record_timestamp"))
    return keyed.where(F.col("ratio").isNotNull() & ~F.isnan("ratio"))


def frame(frames: DataFrame, time_index: str) -> DataFrame:
    """The rows of one frame label, e.g. ``'0930'``."""
    return frames.where(F.col("time_index") == F.lit(time_index))


def frame_keys(frames: DataFrame) -> DataFrame:
    """Distinct frame keys, sorted."""
    return frames.select("time_index").distinct().orderBy("time_index")
