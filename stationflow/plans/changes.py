"""Registered queries of what is kept as changes (key frames, the dimension's history) and of
library functions that other queries only reach in part.

The generated stations never change, so the queries rename and move them by rules that the
oracles repeat; their map frames have few stations a minute, so one query folds the ids into
twelve stations with few different shares.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions import codec
from stationflow.functions.timefn import local_time
from stationflow.operators import flatten, frames, keyframes
from stationflow.plans import history
from stationflow.plans.catalog import (_RECORDS, _STATIONS, TZ, _local, _model, _records, _snapshots, _with)
from stationflow.plans.catalog import ORACLE_SQL as _BASE
from stationflow.plans.lifecycle import _FRAMES, STATION, _work
from stationflow.schemas import RECORD_COLUMNS, STATION_COLUMNS
from stationflow.sources import archive, csvio, drift, sinks, tables, testdata
from stationflow.sources.snapshots import read_snapshots, with_source_file

FRAME = "0930"
ONTO_AUTUMN = 280  # days from the month of the events onto the autumn change


# --------------------------------------------------------------------------- key frames

def _folded_points(spark, sf_dir) -> DataFrame:
    records, stations = _model(spark, sf_dir)
    folded = (records.withColumn("station_id", F.col("station_id") % 12 + 1)
              .withColumn("nb_available_bikes", F.col("nb_available_bikes") % 3)
              .withColumn("nb_available_places", F.lit(2).cast("bigint")))
    return frames.frame_points(folded, stations, tz=TZ)


def q_key_frames(spark, sf_dir):
    """The log of key frames and changes over twelve stations."""
    return keyframes.key_frames(_folded_points(spark, sf_dir)).drop("frame_date")


def q_key_frames_rebuilt(spark, sf_dir):
    """All map frames, rebuilt from the stored log."""
    path = _work(spark, "key-frames")
    records, stations = _model(spark, sf_dir)
    keyframes.write_key_frames(keyframes.key_frames(frames.frame_points(records, stations, tz=TZ)), path)
    back = keyframes.rebuild(keyframes.read_key_frames(spark, path))
    return back.select("minute", "station_id", *keyframes.VALUES)


# --------------------------------------------------------------------------- dimension with history

def _described(spark, sf_dir) -> DataFrame:
    """Realtime rows; a station is renamed on one of ten days, every third moves later."""
    rows = flatten.flatten_realtime(_snapshots(spark, sf_dir))
    day = F.dayofmonth("record_timestamp")
    return (rows.withColumn("name", F.when(day > 10 + F.col("id") % 10, F.concat("name", F.lit(" bis")))
                            .otherwise(F.col("name")))
            .withColumn("city", F.when((day > 20) & (F.col("id") % 3 == 0), F.lit("MOVED")).otherwise(F.col("city"))))


def _history(spark, sf_dir) -> DataFrame:
    """Ranges of three loads: the later days come first, one stretch comes twice."""
    path = f"{_work(spark, 'history')}/descriptions"
    rows, ts = _described(spark, sf_dir), F.col("record_timestamp")
    history.append_descriptions(rows.where(ts >= F.lit(dt.datetime(2024, 1, 14, 9, 20))), path, TZ)
    history.append_descriptions(rows.where(ts < F.lit(dt.datetime(2024, 1, 14, 9, 20))), path, TZ)
    history.append_descriptions(rows.where(ts.between(F.lit(dt.datetime(2024, 1, 9)), F.lit(dt.datetime(2024, 1, 22)))),
                                path, TZ)
    return history.description_ranges(history.kept_descriptions(spark, path))


def q_dimension_history(spark, sf_dir):
    return _history(spark, sf_dir).select(*STATION_COLUMNS, *[
        F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("valid_from", "valid_to")])


def q_dimension_as_of(spark, sf_dir):
    """Every reading with the name and city that its station had on that day."""
    ranges = _history(spark, sf_dir)
    return history.join_as_of(_records(spark, sf_dir), ranges, ["name", "city"], TZ).select(
        "station_id", "record_timestamp", "name", "city")


def q_dimension_current(spark, sf_dir):
    """The latest slice of the history, of snapshots as they are."""
    daily = history.daily_descriptions(flatten.flatten_realtime(_snapshots(spark, sf_dir)), TZ)
    return history.current(history.description_ranges(daily))


# --------------------------------------------------------------------------- single functions

def q_realtime_station(spark, sf_dir):
    """The latest row of one station by its id as text."""
    return flatten.realtime_stations(_snapshots(spark, sf_dir), station=str(STATION))


def q_table_backup(spark, sf_dir):
    """A declared table, its backup, and rows that come in after the backup."""
    name, work = f"records_{uuid.uuid4().hex[:8]}", _work(spark, "backup")
    tables.create_records_table(spark, name, f"{work}/table")
    tables.insert_records(_records(spark, sf_dir), name)
    tables.backup_table(spark, name, f"{name}_backup", f"{work}/copy")
    tables.insert_records(_records(spark, sf_dir), name)
    counts = [spark.read.parquet(f"{work}/{at}").select(F.lit(at).alias("stored"), *RECORD_COLUMNS)
              for at in ("table", "copy")]
    for t in (f"{name}_backup", name):
        spark.sql(f"DROP TABLE {t}")
    return counts[0].unionByName(counts[1])


def q_csv_scan(spark, sf_dir):
    """Time-lapse rows as CSV, scanned with the declared schema."""
    path = _work(spark, "csv")
    records, stations = _model(spark, sf_dir)
    frames.timemap_rows(records, stations).write.option("header", True).csv(path)
    back = csvio.read_csv(spark, path)
    return back.withColumn("record_timestamp", F.date_trunc("second", "record_timestamp"))


def q_frame_keys(spark, sf_dir):
    records, stations = _model(spark, sf_dir)
    return frames.frame_keys(frames.timemap_frames(frames.timemap_rows(records, stations)))


def q_frame_of_label(spark, sf_dir):
    records, stations = _model(spark, sf_dir)
    one = frames.frame(frames.timemap_frames(frames.timemap_rows(records, stations)), FRAME)
    return one.select("time_index", "record_timestamp", "latitude", "longitude", "nb_velos_dispo", "ratio")


def q_frames_json_roundtrip(spark, sf_dir):
    """Packed frames as JSON lines: the entries of each label."""
    path = _work(spark, "frames-json")
    records, stations = _model(spark, sf_dir)
    sinks.write_frames_json(frames.animation_frames(records, stations, tz=TZ), path)
    back = spark.read.schema("minute string, latitude array<double>, longitude array<double>, "
                             "taux_velos_dispo array<double>").json(path)
    sums = [F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 6).alias(f"sum_{c}") for c in ("latitude", "longitude")]
    return back.select("minute", F.size("latitude").alias("entries"), *sums)


def q_snapshot_names(spark, sf_dir):
    """File names of the capture minutes, and the instants that they tell again."""
    minutes = _snapshots(spark, sf_dir).select("capture_minute").distinct()
    name = codec.snapshot_file_name(local_time("capture_minute", TZ))
    return minutes.select(name.alias("file_name"), codec.capture_time_from_name(name, TZ).alias("captured_at"),
                          codec.sanitize_name(F.date_format("capture_minute", "yyyy-MM-dd HH:mm")).alias("object_name"))


def q_archive_captures(spark, sf_dir):
    """An hourly archive over the autumn change, in two batches of which one is repeated: documents
    and station rows by the capture time that the file names tell."""
    path = _work(spark, "captures")
    move = F.make_dt_interval(days=F.lit(ONTO_AUTUMN))
    docs = _snapshots(spark, sf_dir).withColumn("captured_at", F.date_trunc("hour", "capture_minute") + move)
    docs = docs.drop("capture_minute")
    middle = F.lit(dt.datetime(2024, 10, 20, 7))
    archive.archive_captures(docs.where(F.col("captured_at") >= middle), path, tz=TZ, batch="late")
    archive.archive_captures(docs.where(F.col("captured_at") < middle), path, tz=TZ, batch="early")
    archive.archive_captures(docs.where(F.col("captured_at") >= middle), path, tz=TZ, batch="late")
    back = with_source_file(read_snapshots(spark, path), TZ)
    return back.groupBy("captured_at").agg(F.count(F.lit(1)).alias("documents"),
                                           F.sum(F.size("records").cast("bigint")).alias("station_rows"),
                                           F.count_distinct("source_file").alias("files"))


def _open_feed(spark, sf_dir) -> DataFrame:
    """Documents of a feed that has changed: some have a new field, some bikes as text, some places
    as text that is no number."""
    path = _work(spark, "open-feed")
    minute = F.floor(F.unix_seconds("capture_minute") / 60)
    line = F.to_json(F.struct("nhits", "records"), {"timestampFormat": sinks.JSON_TIMESTAMP_FORMAT})
    for every, pattern, new in ((5, '"etat":', '"ebike":1.5,"etat":'), (7, '"nbvelosdispo":(\\d+)', '"nbvelosdispo":"$1"'),
                                (11, '"nbplacesdispo":(\\d+)', '"nbplacesdispo":"$1 of 60"')):
        line = F.when(minute % every == 0, F.regexp_replace(line, pattern, new)).otherwise(line)
    _snapshots(spark, sf_dir).select(line.alias("value")).write.text(path)
    return drift.read_variants(spark, path)


def q_open_feed_records(spark, sf_dir):
    return drift.flatten_variants(_open_feed(spark, sf_dir))


def q_open_feed_drift(spark, sf_dir):
    return drift.drift_report(_open_feed(spark, sf_dir))


def q_message_payloads(spark, sf_dir):
    """Payloads as messages carry them, base64 of JSON text, read again."""
    events = testdata.load_table(spark, sf_dir, "events")
    text = codec.decode_base64_text(F.base64(F.encode("props", "UTF-8")))
    return events.select("event_id", codec.json_field(text, "k").alias("k"))


QUERIES = {
    "key_frames": q_key_frames,
    "key_frames_rebuilt": q_key_frames_rebuilt,
    "dimension_history": q_dimension_history,
    "dimension_as_of": q_dimension_as_of,
    "dimension_current": q_dimension_current,
    "realtime_station": q_realtime_station,
    "table_backup": q_table_backup,
    "csv_scan": q_csv_scan,
    "frame_keys": q_frame_keys,
    "frame_of_label": q_frame_of_label,
    "frames_json_roundtrip": q_frames_json_roundtrip,
    "snapshot_names": q_snapshot_names,
    "archive_captures": q_archive_captures,
    "open_feed_records": q_open_feed_records,
    "open_feed_drift": q_open_feed_drift,
    "message_payloads": q_message_payloads,
}


# --------------------------------------------------------------------------- oracles

_ENTRIES = _FRAMES.replace("p.latitude, p.taux", "p.latitude, p.longitude, p.taux")

# Every minute's frame at full length; the log follows from each minute and the one before.
_DENSE = """folded AS (
  SELECT * REPLACE (station_id % 12 + 1 AS station_id, nb_available_bikes % 3 AS nb_available_bikes,
                    2 AS nb_available_places) FROM records),
pts AS (
  SELECT date_trunc('minute', record_timestamp) AS minute, station_id, record_timestamp, latitude, longitude,
         nb_available_bikes / nullif(nb_available_bikes + nb_available_places, 0) AS taux_velos_dispo
  FROM folded JOIN stations ON stations.id = folded.station_id
  WHERE operational_state = 'EN SERVICE' AND record_timestamp IS NOT NULL),
numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY minute, station_id
      ORDER BY record_timestamp, latitude NULLS FIRST, longitude NULLS FIRST, taux_velos_dispo NULLS FIRST) AS INTEGER) AS nth
  FROM pts),
spans AS (
  SELECT minute, coalesce(lead(minute) OVER (ORDER BY minute) - INTERVAL 1 MINUTE, minute) AS last
  FROM (SELECT DISTINCT minute FROM pts)),
d AS (
  SELECT unnest(generate_series(p.minute, s.last, INTERVAL 1 MINUTE)) AS minute, p.station_id, p.nth, p.latitude,
         p.longitude, p.taux_velos_dispo
  FROM numbered p JOIN spans s ON s.minute = p.minute),
edge AS (SELECT min(minute) AS start FROM d)"""

_DESCRIBED = f"""described AS (
  SELECT station_id AS id,
         CASE WHEN day(record_timestamp) > 10 + station_id % 10 THEN name || ' bis' ELSE name END AS name, adress,
         CASE WHEN day(record_timestamp) > 20 AND station_id % 3 = 0 THEN 'MOVED' ELSE city END AS city,
         type, latitude, longitude, record_timestamp, CAST({_local('record_timestamp')} AS DATE) AS d
  FROM records LEFT JOIN stations ON stations.id = records.station_id
  WHERE station_id IS NOT NULL AND record_timestamp IS NOT NULL),
daily AS (
  SELECT * FROM described QUALIFY row_number() OVER (PARTITION BY id, d ORDER BY record_timestamp DESC) = 1),
along AS (
  SELECT *, lag(name) OVER w AS old_name, lag(city) OVER w AS old_city, row_number() OVER w AS nth
  FROM daily WINDOW w AS (PARTITION BY id ORDER BY d)),
ranges AS (
  SELECT id, name, adress, city, type, latitude, longitude, d AS valid_from,
         lead(d) OVER (PARTITION BY id ORDER BY d) AS valid_to
  FROM along WHERE nth = 1 OR name IS DISTINCT FROM old_name OR city IS DISTINCT FROM old_city)"""

_KIND = "aged AS (SELECT *, CAST(floor(epoch(record_timestamp) / 60) AS BIGINT) AS m FROM records)"

ORACLE_SQL = {
    "key_frames": _with(_RECORDS, _STATIONS, _DENSE) + """
SELECT date_trunc('hour', d.minute) AS frame_hour, d.minute,
       CASE WHEN d.minute = date_trunc('hour', d.minute) OR d.minute = edge.start THEN 'key' ELSE 'change' END AS kind,
       d.station_id, d.nth, d.latitude, d.longitude, d.taux_velos_dispo
FROM d CROSS JOIN edge LEFT JOIN d p
  ON p.minute = d.minute - INTERVAL 1 MINUTE AND p.station_id = d.station_id AND p.nth = d.nth
WHERE d.minute = date_trunc('hour', d.minute) OR p.minute IS NULL OR p.latitude IS DISTINCT FROM d.latitude
   OR p.longitude IS DISTINCT FROM d.longitude OR p.taux_velos_dispo IS DISTINCT FROM d.taux_velos_dispo
UNION ALL
SELECT date_trunc('hour', p.minute), p.minute + INTERVAL 1 MINUTE, 'gone', p.station_id, p.nth, NULL, NULL, NULL
FROM d p LEFT JOIN d
  ON p.minute = d.minute - INTERVAL 1 MINUTE AND p.station_id = d.station_id AND p.nth = d.nth
WHERE d.minute IS NULL AND date_trunc('hour', p.minute) = date_trunc('hour', p.minute + INTERVAL 1 MINUTE)""",

    "key_frames_rebuilt": _with(_RECORDS, _STATIONS, _ENTRIES) + """
SELECT minute, station_id, latitude, longitude, taux_velos_dispo FROM entries""",

    "dimension_history": _with(_RECORDS, _STATIONS, _DESCRIBED) + """
SELECT * REPLACE (strftime(valid_from, '%Y-%m-%d') AS valid_from, strftime(valid_to, '%Y-%m-%d') AS valid_to) FROM ranges""",

    "dimension_as_of": _with(_RECORDS, _STATIONS, _DESCRIBED) + f"""
SELECT r.station_id, r.record_timestamp, s.name, s.city
FROM records r LEFT JOIN ranges s ON s.id = r.station_id
  AND CAST({_local('r.record_timestamp')} AS DATE) >= s.valid_from
  AND (s.valid_to IS NULL OR CAST({_local('r.record_timestamp')} AS DATE) < s.valid_to)""",

    # A station of which nothing but the id is known has a description too: nulls.
    "dimension_current": _with(_RECORDS, _STATIONS) + """
SELECT r.station_id AS id, s.name, s.adress, s.city, s.type, s.latitude, s.longitude
FROM (SELECT DISTINCT station_id FROM records WHERE station_id IS NOT NULL) r LEFT JOIN stations s ON s.id = r.station_id""",

    "realtime_station": f"SELECT * FROM ({_BASE['realtime_stations']}) WHERE id = {STATION}",

    "table_backup": _with(_RECORDS) + """
SELECT 'copy' AS stored, * FROM records UNION ALL SELECT 'table', * FROM records UNION ALL SELECT 'table', * FROM records""",

    "csv_scan": _with(_RECORDS, _STATIONS) + """
SELECT date_trunc('second', record_timestamp) AS record_timestamp, latitude, longitude,
       CAST(nb_available_bikes AS INTEGER) AS nb_velos_dispo,
       nb_available_bikes / nullif(nb_available_bikes + nb_available_places, 0) AS ratio
FROM records JOIN stations ON stations.id = records.station_id""",

    "frame_keys": f"SELECT DISTINCT time_index FROM ({_BASE['timemap_frames']}) ORDER BY time_index",

    "frame_of_label": f"SELECT * FROM ({_BASE['timemap_frames']}) WHERE time_index = '{FRAME}'",

    "frames_json_roundtrip": _with(_RECORDS, _STATIONS, _ENTRIES) + f"""
SELECT strftime({_local('minute')}, '%Y-%m-%d %H:%M') AS minute, CAST(count(*) AS INTEGER) AS entries,
       round(sum(latitude), 6) AS sum_latitude, round(sum(longitude), 6) AS sum_longitude
FROM entries GROUP BY {_local('minute')}, entries.minute""",

    "snapshot_names": _with(_RECORDS, "m AS (SELECT DISTINCT date_trunc('minute', record_timestamp) AS minute FROM records)") + f"""
SELECT strftime({_local('minute')}, 'data___%Y_%m_%d_%H_%M_%S.json') AS file_name, minute AS captured_at,
       strftime(minute, '%Y_%m_%d %H_%M') AS object_name FROM m""",

    "archive_captures": _with(_RECORDS) + f"""
SELECT date_trunc('hour', record_timestamp) + INTERVAL {ONTO_AUTUMN} DAY AS captured_at,
       count(DISTINCT (date_trunc('minute', record_timestamp), floor(station_id / 300))) AS documents,
       count(*) AS station_rows, 1 AS files
FROM records GROUP BY 1""",

    "open_feed_records": _with(_RECORDS, _KIND) + """
SELECT * EXCLUDE (m) REPLACE (CASE WHEN m % 11 <> 0 THEN nb_available_places END AS nb_available_places),
       CASE WHEN m % 5 = 0 OR m % 11 = 0 AND nb_available_places IS NOT NULL THEN '{"fields":{' || concat_ws(',',
              CASE WHEN m % 5 = 0 THEN '"ebike":1.5' END,
              CASE WHEN m % 11 = 0 THEN '"nbplacesdispo":"' || nb_available_places || ' of 60"' END) || '}}' END AS unknown
FROM aged""",

    "open_feed_drift": _with(_RECORDS, _KIND) + """
SELECT * FROM (
  SELECT '$.records[].fields.ebike' AS path, 'number' AS kind, 'added' AS status, count_if(m % 5 = 0) AS n FROM aged
  UNION ALL
  SELECT '$.records[].fields.nbvelosdispo', 'text', 'retyped', count_if(m % 7 = 0 AND nb_available_bikes IS NOT NULL) FROM aged
  UNION ALL
  SELECT '$.records[].fields.nbplacesdispo', 'text', 'retyped', count_if(m % 11 = 0 AND nb_available_places IS NOT NULL) FROM aged)
WHERE n > 0""",

    "message_payloads": _BASE["json_fields"],
}
