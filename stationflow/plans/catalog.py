"""Registered queries over the generated tables, with their DuckDB oracles.

Every query reads whole tables (``sources.testdata`` maps them to the
bike-share model) and returns a DataFrame. The oracle of a query is plain SQL
over the same Parquet tables; column names and types match the Spark result.
Day keys are ISO text on both sides (Spark ``date`` and DuckDB ``DATE`` reach
pandas as different types).
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.codec import json_field
from stationflow.functions.status import station_status
from stationflow.functions.timefn import axis_label, local_date, local_time
from stationflow.operators import flatten, frames, network, repair, transactions
from stationflow.operators.timeaxis import minute_first, pad_tail
from stationflow.plans import dashboard
from stationflow.schemas import RECORD_COLUMNS
from stationflow.session import scratch_path
from stationflow.sources import testdata
from stationflow.sources.sinks import write_snapshots_json
from stationflow.sources.tables import row_count
from stationflow.streaming.ingest import ingest_stream

# Parameters of the registered queries. The generated data covers 2024-01-01 to
# 2024-01-30 (UTC); every query looks at it from NOW.
TZ = "Europe/Paris"
NOW = dt.datetime(2024, 1, 31, 0, 0)
SERVICE_START = dt.datetime(2024, 1, 1, 0, 0)
LOAD_WINDOW = ("2024-01-03 00:00:00 UTC", "2024-01-28 00:00:00 UTC")
REPAIR_WINDOW = ("2024-01-20 22:35:00 UTC", "2024-01-21 13:40:00 UTC")
# Band of the per-minute network total, scaled to the generated values.
BAND = (10, 400)
REPLICAS = 24

Query = Callable[[SparkSession, str], DataFrame]


def _model(spark: SparkSession, sf_dir: str):
    return testdata.load_model(spark, sf_dir)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.records_from_events(testdata.load_table(spark, sf_dir, "events"))


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, stations = _model(spark, sf_dir)
    return testdata.snapshots_from_records(records, stations)


def _day_text(col: str = "local_date"):
    return F.date_format(F.col(col), "yyyy-MM-dd").alias(col)


# --------------------------------------------------------------------------- queries

def q_transactions_by_hour(spark, sf_dir):
    t = transactions.transactions_by_hour(_records(spark, sf_dir), TZ, pad=False)
    return t.select(_day_text(), "hour_of_day", "borrowed", "returned")


def q_transactions_by_hour_padded(spark, sf_dir):
    t = transactions.transactions_by_hour(_records(spark, sf_dir), TZ, pad=True)
    return t.select(_day_text(), "hour_of_day", "borrowed", "returned")


def q_transactions_by_hour_fixed_offset(spark, sf_dir):
    """The legacy display convention: a fixed +02:00 offset all year."""
    t = transactions.transactions_by_hour(_records(spark, sf_dir), "+02:00", pad=True)
    return t.select(_day_text(), "hour_of_day", "borrowed", "returned")


def q_loans_total(spark, sf_dir):
    t = transactions.loans_total(_records(spark, sf_dir), TZ)
    return t.select(_day_text(), "loans")


def q_station_delta(spark, sf_dir):
    d = transactions.station_deltas(_records(spark, sf_dir), TZ)
    return d.select("station_id", "record_timestamp", _day_text(), "hour_of_day",
                    "transaction_value")


def q_weekday_hour_profile(spark, sf_dir):
    return network.hourly_profile(_records(spark, sf_dir), SERVICE_START, NOW)


def q_network_total(spark, sf_dir):
    return network.network_total(_records(spark, sf_dir), grain="minute")


def q_network_total_band(spark, sf_dir):
    return network.in_band(network.network_total(_records(spark, sf_dir), grain="minute"),
                           "total_bikes", *BAND)


def q_minute_first(spark, sf_dir):
    r = _records(spark, sf_dir).where(F.col("station_id").isNotNull())
    return minute_first(r, ["station_id"], "record_timestamp", ["nb_available_bikes"])


def q_minute_fill_station(spark, sf_dir):
    return dashboard.station_timeline(_records(spark, sf_dir), span=None, tz=TZ, pad=None) \
        .select("station_id", "minute", "nb_available_bikes")


def q_station_day_timeline(spark, sf_dir):
    t = dashboard.station_day_timelines(_records(spark, sf_dir), TZ, day_format="yyyy-MM-dd")
    return t.select("station_id", "local_date", "minute", "nb_available_bikes")


def q_network_timeline(spark, sf_dir):
    return dashboard.network_timeline(_records(spark, sf_dir), span=None, tz=TZ, band=BAND,
                                      pad=None)


def q_network_day_timeline(spark, sf_dir):
    t = dashboard.network_timeline(_records(spark, sf_dir), span=None, tz=TZ, band=BAND,
                                   daily=True)
    return t.select(_day_text(), "minute", "local_minute", "total_bikes")


def q_pad_tail_1440(spark, sf_dir):
    totals = dashboard.network_series(_records(spark, sf_dir), BAND) \
        .withColumn("local_date", local_date("record_timestamp", TZ))
    first = minute_first(totals, ["local_date"], "record_timestamp", ["total_bikes"])
    return pad_tail(first, ["local_date"], ["total_bikes"]).select(
        _day_text(), "minute", "total_bikes")


def q_axis_labels(spark, sf_dir):
    t = dashboard.network_timeline(_records(spark, sf_dir), span=None, tz=TZ, band=BAND,
                                   pad=None)
    return (t.select("local_minute", axis_label("local_minute", "today").alias("tick_day"),
                     axis_label("local_minute", "7d").alias("tick_week"))
            .where(F.col("tick_day").isNotNull() | F.col("tick_week").isNotNull()))


def q_network_kpis(spark, sf_dir):
    return network.network_kpis(network.latest_readings(_records(spark, sf_dir)))


def q_index_kpis(spark, sf_dir):
    return dashboard.index_kpis(_records(spark, sf_dir), dt.datetime(2024, 1, 30, 18, 0), TZ)


def q_station_status(spark, sf_dir):
    r = _records(spark, sf_dir)
    return r.select("station_id", "record_timestamp", station_status().alias("status"))


def q_empty_station_events(spark, sf_dir):
    records, stations = _model(spark, sf_dir)
    return network.empty_station_events(records, stations, SERVICE_START, NOW)


def q_availability_ratio_join(spark, sf_dir):
    records, stations = _model(spark, sf_dir)
    pts = frames.frame_points(records, stations, tz=TZ)
    return pts.select("station_id", "record_timestamp", "latitude", "longitude",
                      "taux_velos_dispo")


def q_unnest_snapshot(spark, sf_dir):
    return flatten.flatten_snapshots(_snapshots(spark, sf_dir))


def q_zip_arrays_unnest(spark, sf_dir):
    arrays = flatten.nested_arrays(_snapshots(spark, sf_dir))
    return flatten.zip_arrays_to_rows(arrays, arrays.columns)


def q_replicate_rows(spark, sf_dir):
    _, stations = _model(spark, sf_dir)
    return flatten.replicate(stations.select("id", "name"), REPLICAS)


def q_array_element_coords(spark, sf_dir):
    e = testdata.load_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.get("embedding", 0).cast("double").alias("latitude"),
                    F.get("embedding", 1).cast("double").alias("longitude"))


def q_latest_dimension(spark, sf_dir):
    return flatten.stations_from_snapshots(_snapshots(spark, sf_dir))


def q_realtime_stations(spark, sf_dir):
    return flatten.realtime_stations(_snapshots(spark, sf_dir))


def q_snapshot_load_report(spark, sf_dir):
    return flatten.expected_rows(_snapshots(spark, sf_dir))


def q_backfill_window(spark, sf_dir):
    return repair.backfill(_snapshots(spark, sf_dir), *LOAD_WINDOW)


def q_repair_window(spark, sf_dir):
    return repair.repair_window(_records(spark, sf_dir), *REPAIR_WINDOW)


def q_animation_frames(spark, sf_dir):
    records, stations = _model(spark, sf_dir)
    e = frames.frame_entries(frames.frame_points(records, stations, tz=TZ), TZ)
    return e.select(F.col("local_minute").alias("minute"),
                    local_time("observed_minute", TZ).alias("observed_minute"), "station_id", "record_timestamp",
                    "latitude", "longitude", "taux_velos_dispo")


def q_timemap_frames(spark, sf_dir):
    records, stations = _model(spark, sf_dir)
    return frames.timemap_frames(frames.timemap_rows(records, stations)).select(
        "time_index", "record_timestamp", "latitude", "longitude", "nb_velos_dispo", "ratio")


def q_row_count(spark, sf_dir):
    return row_count(_records(spark, sf_dir))


def q_json_fields(spark, sf_dir):
    e = testdata.load_table(spark, sf_dir, "events")
    return e.select("event_id", json_field("props", "k").alias("k"))


def q_stream_ingest(spark, sf_dir):
    """The minute ingest end to end: snapshot documents derived from the tables
    are written as JSON files, a Structured Streaming query picks them up
    (``availableNow``) and appends to a Parquet sink; the sink is returned."""
    work = scratch_path(spark, f"stream-ingest-{uuid.uuid4().hex[:12]}")
    src, sink, ckpt = (os.path.join(work, n) for n in ("raw", "records", "_checkpoint"))
    write_snapshots_json(_snapshots(spark, sf_dir).drop("capture_minute"), src)
    query = ingest_stream(spark, src, sink, ckpt, available_now=True)
    query.awaitTermination()
    return spark.read.parquet(sink).select(*RECORD_COLUMNS)


QUERIES: dict[str, Query] = {
    "transactions_by_hour": q_transactions_by_hour,
    "transactions_by_hour_padded": q_transactions_by_hour_padded,
    "transactions_by_hour_fixed_offset": q_transactions_by_hour_fixed_offset,
    "loans_total": q_loans_total,
    "station_delta": q_station_delta,
    "weekday_hour_profile": q_weekday_hour_profile,
    "network_total": q_network_total,
    "network_total_band": q_network_total_band,
    "minute_first": q_minute_first,
    "minute_fill_station": q_minute_fill_station,
    "station_day_timeline": q_station_day_timeline,
    "network_timeline": q_network_timeline,
    "network_day_timeline": q_network_day_timeline,
    "pad_tail_1440": q_pad_tail_1440,
    "axis_labels": q_axis_labels,
    "network_kpis": q_network_kpis,
    "index_kpis": q_index_kpis,
    "station_status": q_station_status,
    "empty_station_events": q_empty_station_events,
    "availability_ratio_join": q_availability_ratio_join,
    "unnest_snapshot": q_unnest_snapshot,
    "zip_arrays_unnest": q_zip_arrays_unnest,
    "replicate_rows": q_replicate_rows,
    "array_element_coords": q_array_element_coords,
    "latest_dimension": q_latest_dimension,
    "realtime_stations": q_realtime_stations,
    "snapshot_load_report": q_snapshot_load_report,
    "backfill_window": q_backfill_window,
    "repair_window": q_repair_window,
    "animation_frames": q_animation_frames,
    "timemap_frames": q_timemap_frames,
    "row_count": q_row_count,
    "json_fields": q_json_fields,
    "stream_ingest": q_stream_ingest,
}


# --------------------------------------------------------------------------- oracles

_RECORDS = """records AS (
  SELECT user_id AS station_id,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'EN SERVICE'
              WHEN event_type = 'error' THEN 'IN_MAINTENANCE'
              WHEN event_type = 'signup' THEN 'RÉFORMÉ' END AS operational_state,
         CAST(floor(value) AS BIGINT) AS nb_available_bikes,
         CAST(props->>'k' AS BIGINT) AS nb_available_places,
         event_type AS connexion,
         ts AS last_update,
         ts AS record_timestamp
  FROM events)"""

_STATIONS = """stations AS (
  SELECT c.c_custkey AS id, c.c_name AS name, CAST(NULL AS VARCHAR) AS adress,
         n.n_name AS city, c.c_mktsegment AS type,
         CAST(e.embedding[1] AS DOUBLE) AS latitude, CAST(e.embedding[2] AS DOUBLE) AS longitude
  FROM customer c
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN embeddings e ON e.vec_id = c.c_custkey)"""


def _local(expr: str) -> str:
    return f"timezone('{TZ}', timezone('UTC', {expr}))"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_DELTAS = f"""d AS (
  SELECT station_id, record_timestamp, {_local('record_timestamp')} AS local_ts, nb_available_bikes
  FROM records WHERE station_id IS NOT NULL AND record_timestamp IS NOT NULL),
c AS (
  SELECT station_id, record_timestamp, CAST(local_ts AS DATE) AS local_date,
         CAST(hour(local_ts) AS INTEGER) AS hour_of_day,
         LAG(nb_available_bikes) OVER (PARTITION BY station_id, CAST(local_ts AS DATE)
                                       ORDER BY record_timestamp, local_ts) - nb_available_bikes AS v
  FROM d),
deltas AS (SELECT * FROM c WHERE v IS NOT NULL AND v <> 0),
hourly AS (
  SELECT local_date, hour_of_day,
         CAST(SUM(CASE WHEN v > 0 THEN v ELSE 0 END) AS BIGINT) AS borrowed,
         CAST(SUM(CASE WHEN v < 0 THEN -v ELSE 0 END) AS BIGINT) AS returned
  FROM deltas GROUP BY local_date, hour_of_day)"""


def _fill(src: str, keys: list[str], value: str, out: str) -> str:
    """SQL of first-per-minute → lead → generate_series for ``src``."""
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    part = f"PARTITION BY {k} " if keys else ""
    return f"""{out}_m AS (
  SELECT {kc}date_trunc('minute', record_timestamp) AS minute,
         arg_min({value}, record_timestamp) FILTER (WHERE {value} IS NOT NULL) AS {value}
  FROM {src} GROUP BY ALL),
{out}_n AS (
  SELECT *, lead(minute) OVER ({part}ORDER BY minute) AS nxt FROM {out}_m),
{out} AS (
  SELECT {kc}unnest(generate_series(minute, coalesce(nxt - INTERVAL 1 MINUTE, minute),
                                    INTERVAL 1 MINUTE)) AS minute, {value}
  FROM {out}_n)"""


def _pad(src: str, keys: list[str], value: str, vtype: str, out: str, length: int = 1440) -> str:
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    grp = f"GROUP BY {k}" if keys else ""
    return f"""{out}_s AS (
  SELECT {kc}count(*) AS n, max(minute) AS last FROM {src} {grp}),
{out} AS (
  SELECT {kc}minute, {value} FROM {src}
  UNION ALL
  SELECT {kc}last + to_minutes(i) AS minute, CAST(NULL AS {vtype}) AS {value}
  FROM {out}_s, LATERAL (SELECT unnest(generate_series(1, {length} - n)) AS i) g
  WHERE n < {length})"""


_NET = f"""net AS (
  SELECT record_timestamp, CAST(SUM(nb_available_bikes) AS BIGINT) AS total_bikes
  FROM records WHERE record_timestamp IS NOT NULL GROUP BY record_timestamp
  HAVING SUM(nb_available_bikes) > {BAND[0]} AND SUM(nb_available_bikes) < {BAND[1]})"""

_NET_DAY = f"""netd AS (
  SELECT CAST({_local('record_timestamp')} AS DATE) AS local_date, * FROM net)"""

def _newest(condition: str = "") -> str:
    """The row with the latest time of every station; ``arg_max`` would skip nulls."""
    return f"""latest AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY record_timestamp DESC, last_update DESC) AS place
    FROM records WHERE station_id IS NOT NULL AND record_timestamp IS NOT NULL{condition})
  WHERE place = 1)"""


_LATEST = _newest()

_KPIS = """
  CAST(SUM(nb_available_bikes) AS BIGINT) AS nb_available_bikes,
  CAST(SUM(nb_available_places) AS BIGINT) AS nb_available_places,
  CAST(count_if(nb_available_bikes = 0 AND operational_state = 'EN SERVICE') AS BIGINT) AS nb_empty_stations,
  CAST(count_if(nb_available_places = 0 AND operational_state = 'EN SERVICE') AS BIGINT) AS nb_full_stations,
  CAST(count_if(nb_available_bikes > 0 AND operational_state = 'EN SERVICE') AS BIGINT)
      AS nb_stations_w_n_bikes_greater_than_zero,
  CAST(count_if(nb_available_places > 0 AND operational_state = 'EN SERVICE') AS BIGINT)
      AS nb_stations_w_n_places_greater_than_zero,
  CAST(count_if(operational_state = 'EN SERVICE') AS BIGINT) AS nb_stations_in_service,
  CAST(count_if(operational_state = 'IN_MAINTENANCE') AS BIGINT) AS nb_stations_in_maintenance,
  CAST(count_if(operational_state = 'RÉFORMÉ') AS BIGINT) AS nb_stations_reformed"""

_POINTS = f"""pts AS (
  SELECT date_trunc('minute', {_local('record_timestamp')}) AS minute, station_id, record_timestamp,
         latitude, longitude,
         nb_available_bikes / nullif(nb_available_bikes + nb_available_places, 0) AS taux_velos_dispo
  FROM records JOIN stations ON stations.id = records.station_id
  WHERE operational_state = 'EN SERVICE')"""


def _ts(text: str) -> str:
    return f"TIMESTAMP '{text.replace(' UTC', '')}'"


ORACLE_SQL: dict[str, str] = {
    "transactions_by_hour": _with(_RECORDS, _DELTAS) + """
SELECT strftime(local_date, '%Y-%m-%d') AS local_date, hour_of_day, borrowed, returned FROM hourly""",

    "transactions_by_hour_padded": _with(_RECORDS, _DELTAS, f"""days AS (
  SELECT DISTINCT CAST({_local('record_timestamp')} AS DATE) AS local_date
  FROM records WHERE record_timestamp IS NOT NULL),
axis AS (SELECT local_date, CAST(h AS INTEGER) AS hour_of_day FROM days, range(24) t(h))""") + """
SELECT strftime(a.local_date, '%Y-%m-%d') AS local_date, a.hour_of_day,
       coalesce(h.borrowed, 0) AS borrowed, coalesce(h.returned, 0) AS returned
FROM axis a LEFT JOIN hourly h USING (local_date, hour_of_day)""",

    "transactions_by_hour_fixed_offset": _with(
        _RECORDS, _DELTAS.replace(_local('record_timestamp'), "record_timestamp + INTERVAL 2 HOUR"),
        """days AS (
  SELECT DISTINCT CAST(record_timestamp + INTERVAL 2 HOUR AS DATE) AS local_date
  FROM records WHERE record_timestamp IS NOT NULL),
axis AS (SELECT local_date, CAST(h AS INTEGER) AS hour_of_day FROM days, range(24) t(h))""") + """
SELECT strftime(a.local_date, '%Y-%m-%d') AS local_date, a.hour_of_day,
       coalesce(h.borrowed, 0) AS borrowed, coalesce(h.returned, 0) AS returned
FROM axis a LEFT JOIN hourly h USING (local_date, hour_of_day)""",

    "loans_total": _with(_RECORDS, _DELTAS) + """
SELECT strftime(local_date, '%Y-%m-%d') AS local_date, CAST(SUM(borrowed) AS BIGINT) AS loans
FROM hourly GROUP BY local_date""",

    "station_delta": _with(_RECORDS, _DELTAS) + """
SELECT station_id, record_timestamp, strftime(local_date, '%Y-%m-%d') AS local_date, hour_of_day,
       v AS transaction_value
FROM deltas""",

    "weekday_hour_profile": _with(_RECORDS) + f"""
SELECT station_id, CAST(dayofweek(record_timestamp) + 1 AS INTEGER) AS day_of_week,
       CAST(hour(record_timestamp) AS INTEGER) AS hour_of_day,
       avg(nb_available_bikes) AS avg_nb_available_bikes
FROM records
WHERE record_timestamp >= TIMESTAMP '{SERVICE_START:%Y-%m-%d %H:%M:%S}'
  AND record_timestamp < TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}'
GROUP BY ALL""",

    "network_total": _with(_RECORDS) + """
SELECT date_trunc('minute', record_timestamp) AS record_timestamp,
       CAST(SUM(nb_available_bikes) AS BIGINT) AS total_bikes, count(*) AS readings
FROM records WHERE record_timestamp IS NOT NULL GROUP BY 1""",

    "network_total_band": _with(_RECORDS) + f"""
SELECT date_trunc('minute', record_timestamp) AS record_timestamp,
       CAST(SUM(nb_available_bikes) AS BIGINT) AS total_bikes, count(*) AS readings
FROM records WHERE record_timestamp IS NOT NULL GROUP BY 1
HAVING SUM(nb_available_bikes) > {BAND[0]} AND SUM(nb_available_bikes) < {BAND[1]}""",

    "minute_first": _with(_RECORDS) + """
SELECT station_id, date_trunc('minute', record_timestamp) AS minute,
       arg_min(nb_available_bikes, record_timestamp) FILTER (WHERE nb_available_bikes IS NOT NULL)
           AS nb_available_bikes
FROM records WHERE station_id IS NOT NULL GROUP BY 1, 2""",

    "minute_fill_station": _with(
        _RECORDS, "src AS (SELECT * FROM records WHERE station_id IS NOT NULL)",
        _fill("src", ["station_id"], "nb_available_bikes", "filled")) + """
SELECT station_id, minute, nb_available_bikes FROM filled""",

    "station_day_timeline": _with(
        _RECORDS, f"""src AS (
  SELECT *, CAST({_local('record_timestamp')} AS DATE) AS local_date
  FROM records WHERE station_id IS NOT NULL AND record_timestamp IS NOT NULL)""",
        _fill("src", ["station_id", "local_date"], "nb_available_bikes", "filled"),
        _pad("filled", ["station_id", "local_date"], "nb_available_bikes", "BIGINT", "padded")) + f"""
SELECT station_id, strftime(local_date, '%Y-%m-%d') AS local_date, minute, nb_available_bikes
FROM padded""",

    "network_timeline": _with(_RECORDS, _NET, _fill("net", [], "total_bikes", "filled")) + f"""
SELECT minute, {_local('minute')} AS local_minute, total_bikes FROM filled""",

    "network_day_timeline": _with(
        _RECORDS, _NET, _NET_DAY, _fill("netd", ["local_date"], "total_bikes", "filled"),
        _pad("filled", ["local_date"], "total_bikes", "BIGINT", "padded")) + f"""
SELECT strftime(local_date, '%Y-%m-%d') AS local_date, minute, {_local('minute')} AS local_minute,
       total_bikes
FROM padded""",

    "pad_tail_1440": _with(_RECORDS, _NET, _NET_DAY, """first AS (
  SELECT local_date, date_trunc('minute', record_timestamp) AS minute,
         arg_min(total_bikes, record_timestamp) FILTER (WHERE total_bikes IS NOT NULL) AS total_bikes
  FROM netd GROUP BY ALL)""", _pad("first", ["local_date"], "total_bikes", "BIGINT", "padded")) + """
SELECT strftime(local_date, '%Y-%m-%d') AS local_date, minute, total_bikes FROM padded""",

    "axis_labels": _with(_RECORDS, _NET, _fill("net", [], "total_bikes", "filled"), f"""lab AS (
  SELECT {_local('minute')} AS local_minute FROM filled),
t AS (
  SELECT local_minute,
         CASE WHEN minute(local_minute) = 0 AND hour(local_minute) % 3 = 0
              THEN strftime(local_minute, '%H') || 'h' END AS tick_day,
         CASE WHEN minute(local_minute) = 0 AND hour(local_minute) = 0
              THEN strftime(local_minute, '%d/%m') END AS tick_week
  FROM lab)""") + """
SELECT * FROM t WHERE tick_day IS NOT NULL OR tick_week IS NOT NULL""",

    "network_kpis": _with(_RECORDS, _LATEST) + f"SELECT {_KPIS}\nFROM latest",

    "index_kpis": _with(_RECORDS, _DELTAS.replace(
        "FROM records WHERE station_id IS NOT NULL",
        "FROM records WHERE record_timestamp < TIMESTAMP '2024-01-30 18:00:00' "
        "AND station_id IS NOT NULL"), _newest(" AND record_timestamp < TIMESTAMP '2024-01-30 18:00:00'")) + f"""
SELECT {_KPIS},
  (SELECT CAST(coalesce(SUM(borrowed), 0) AS BIGINT) FROM hourly
   WHERE local_date = DATE '2024-01-30') AS todays_loan_count
FROM latest""",

    "station_status": _with(_RECORDS) + """
SELECT station_id, record_timestamp,
       CASE WHEN operational_state = 'RÉFORMÉ' THEN 'reformed'
            WHEN operational_state = 'IN_MAINTENANCE' THEN 'maintenance'
            WHEN nb_available_bikes = 0 THEN 'empty'
            WHEN nb_available_bikes BETWEEN 1 AND 4 THEN 'low'
            WHEN nb_available_places = 0 THEN 'full'
            ELSE 'ok' END AS status
FROM records""",

    "empty_station_events": _with(_RECORDS, _STATIONS) + f"""
SELECT record_timestamp, station_id, name
FROM records JOIN stations ON stations.id = records.station_id
WHERE record_timestamp >= TIMESTAMP '{SERVICE_START:%Y-%m-%d %H:%M:%S}'
  AND record_timestamp < TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}'
  AND nb_available_bikes = 0 AND operational_state = 'EN SERVICE'
ORDER BY record_timestamp, name""",

    "availability_ratio_join": _with(_RECORDS, _STATIONS, _POINTS) + """
SELECT station_id, record_timestamp, latitude, longitude, taux_velos_dispo FROM pts""",

    "unnest_snapshot": _with(_RECORDS) + "SELECT * FROM records",

    "zip_arrays_unnest": _with(_RECORDS) + """
SELECT CAST(nb_available_bikes AS INTEGER) AS nb_available_bikes,
       CAST(nb_available_places AS INTEGER) AS nb_available_places,
       CAST(station_id AS VARCHAR) AS station_id, operational_state, connexion, last_update,
       record_timestamp
FROM records""",

    "replicate_rows": _with(_STATIONS) + f"""
SELECT id, name, CAST(copy AS INTEGER) AS copy
FROM stations, range(1, {REPLICAS + 1}) t(copy)""",

    "array_element_coords": """
SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS latitude, CAST(embedding[2] AS DOUBLE) AS longitude
FROM embeddings""",

    "latest_dimension": _with(_RECORDS, _STATIONS) + """
SELECT s.* FROM stations s
WHERE s.id IN (SELECT station_id FROM records WHERE station_id IS NOT NULL)""",

    "realtime_stations": _with(_RECORDS, _STATIONS, _LATEST) + """
SELECT s.name, l.station_id AS id, s.adress, s.city, s.type, s.latitude, s.longitude,
       l.operational_state, l.nb_available_bikes, l.nb_available_places, l.connexion,
       l.last_update, l.record_timestamp
FROM latest l LEFT JOIN stations s ON s.id = l.station_id""",

    "snapshot_load_report": _with(_RECORDS) + """
SELECT count(DISTINCT (date_trunc('minute', record_timestamp), floor(station_id / 300)))
           AS documents,
       count(*) AS station_rows
FROM records""",

    "backfill_window": _with(_RECORDS) + f"""
SELECT * FROM records
WHERE NOT coalesce(record_timestamp < {_ts(LOAD_WINDOW[0])}
                   OR record_timestamp >= {_ts(LOAD_WINDOW[1])}, false)
  AND station_id IS NOT NULL""",

    "repair_window": _with(_RECORDS, f"""kept AS (
  SELECT * FROM records
  WHERE NOT coalesce(record_timestamp BETWEEN {_ts(REPAIR_WINDOW[0])} AND {_ts(REPAIR_WINDOW[1])},
                     false)),
moved AS (
  SELECT * REPLACE (record_timestamp + INTERVAL 7 DAY AS record_timestamp) FROM kept
  WHERE record_timestamp BETWEEN {_ts(REPAIR_WINDOW[0])} - INTERVAL 7 DAY
                             AND {_ts(REPAIR_WINDOW[1])} - INTERVAL 7 DAY)""") + """
SELECT * FROM kept UNION ALL SELECT * FROM moved""",

    "animation_frames": _with(_RECORDS, _STATIONS, _POINTS, """mins AS (
  SELECT DISTINCT minute FROM pts),
spans AS (
  SELECT minute, coalesce(lead(minute) OVER (ORDER BY minute) - INTERVAL 1 MINUTE, minute) AS last
  FROM mins)""") + """
SELECT unnest(generate_series(p.minute, s.last, INTERVAL 1 MINUTE)) AS minute,
       p.minute AS observed_minute, p.station_id, p.record_timestamp, p.latitude, p.longitude,
       p.taux_velos_dispo
FROM pts p JOIN spans s ON s.minute = p.minute""",

    "timemap_frames": _with(_RECORDS, _STATIONS, """rows AS (
  SELECT record_timestamp, latitude, longitude, CAST(nb_available_bikes AS INTEGER) AS nb_velos_dispo,
         nb_available_bikes / nullif(nb_available_bikes + nb_available_places, 0) AS ratio
  FROM records JOIN stations ON stations.id = records.station_id)""") + """
SELECT strftime(record_timestamp, '%H%M') AS time_index, record_timestamp, latitude, longitude,
       nb_velos_dispo, ratio
FROM rows
WHERE record_timestamp IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
  AND nb_velos_dispo IS NOT NULL AND ratio IS NOT NULL AND NOT isnan(ratio)""",

    "row_count": _with(_RECORDS) + "SELECT count(*) AS row_count FROM records",

    "json_fields": "SELECT event_id, CAST(props->>'k' AS BIGINT) AS k FROM events",

    "stream_ingest": _with(_RECORDS) + "SELECT * FROM records WHERE station_id IS NOT NULL",
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
