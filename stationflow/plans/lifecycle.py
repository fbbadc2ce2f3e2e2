"""Registered queries of stored tables, clock changes, spans and uneven data.

The generated events are one winter month without nulls or equal timestamps. These
queries derive what is missing from them by rules that their oracles repeat: days moved
onto both clock changes, nulls in the measures, equal times, full minute snapshots,
damaged documents. The life-cycle queries write tables to the shared folder and read
them back.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.timefn import local_date, local_time, ts_literal
from stationflow.operators import flatten, frames, intervals, network, transactions
from stationflow.operators.filters import time_range
from stationflow.operators.repair import touched_dates
from stationflow.operators.timeaxis import minute_first
from stationflow.plans import dashboard, ledger, maintenance, rollups
from stationflow.plans.catalog import (_KPIS, _LATEST, _NET, _RECORDS, _STATIONS, BAND, NOW, REPAIR_WINDOW,
                                       SERVICE_START, TZ, _day_text, _fill, _local, _model, _pad, _records,
                                       _snapshots, _ts, _with)
from stationflow.plans.catalog import ORACLE_SQL as _BASE
from stationflow.schemas import RECORD_COLUMNS, RECORD_DATE, SNAPSHOT
from stationflow.session import scratch_path
from stationflow.sources import dated, sinks, tables, testdata
from stationflow.sources.snapshots import read_snapshots
from stationflow.streaming.ingest import ingest_stream
from stationflow.streaming.transactions import kept_transactions, transactions_stream

REPLACED = ("2024-01-05 10:30:00 UTC", "2024-01-07 16:45:00 UTC")
SHIFTS = (280, 75)  # days onto the autumn and the spring change of 2024
KPI_NOW = dt.datetime(2024, 1, 30, 18, 0)
STATION, WEEKDAY = 42, "Monday"
FIRST_DAY = ("2024-01-05 00:00:00 UTC", "2024-01-05 10:30:00 UTC")  # before the replaced window
BEFORE = ("2023-12-31 00:00:00 UTC", "2024-01-12 07:30:00 UTC")
TWO_HOURS = ("2024-01-10 23:00:00 UTC", "2024-01-11 01:00:00 UTC")


def _work(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


# --------------------------------------------------------------------------- stored tables

def q_load_window_replace(spark, sf_dir):
    """A table whose counts are 100 too high; a load puts part of three days right."""
    work = _work(spark, "load-window")
    stored = _records(spark, sf_dir).withColumn("nb_available_bikes", F.col("nb_available_bikes") + 100)
    sinks.append_records(stored, f"{work}/records")
    sinks.write_snapshots_json(_snapshots(spark, sf_dir).drop("capture_minute"), f"{work}/raw")
    maintenance.load_window(spark, f"{work}/raw", f"{work}/records", *REPLACED, replace=True,
                            quarantine_path=f"{work}/rejects")
    return sinks.read_records(spark, f"{work}/records").select(*RECORD_COLUMNS)


def q_stream_then_repair(spark, sf_dir):
    """Stream into a table, append to it, repair it, read it."""
    work = _work(spark, "stream-repair")
    table = f"{work}/records"
    sinks.write_snapshots_json(_snapshots(spark, sf_dir).drop("capture_minute"), f"{work}/raw")
    ingest_stream(spark, f"{work}/raw", table, f"{work}/_checkpoint", available_now=True).awaitTermination()
    sinks.append_records(_records(spark, sf_dir), table)
    maintenance.repair_stored(spark, table, *REPAIR_WINDOW)
    return sinks.read_records(spark, table).select(*RECORD_COLUMNS)


def q_index_kpis_latest(spark, sf_dir):
    """KPIs from the table of latest readings, merged from two loads out of order."""
    path = _work(spark, "latest")
    before = _records(spark, sf_dir).where(F.col("record_timestamp") < F.lit(KPI_NOW))
    middle = F.lit(dt.datetime(2024, 1, 15))
    maintenance.merge_latest(spark, before.where(F.col("record_timestamp") >= middle), path)
    maintenance.merge_latest(spark, before.where(F.col("record_timestamp") < middle), path)
    return dashboard.index_kpis(_records(spark, sf_dir), KPI_NOW, TZ, maintenance.read_latest(spark, path))


def q_table_backup_roundtrip(spark, sf_dir):
    """Create with the declared schema, insert by position, back up, read the copy."""
    name = f"records_{uuid.uuid4().hex[:8]}"
    tables.create_records_table(spark, name, _work(spark, "table"))
    tables.insert_records(_records(spark, sf_dir), name)
    copy = _work(spark, "backup")
    spark.table(name).write.parquet(copy)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(copy).select(*RECORD_COLUMNS)


def q_bronze_roundtrip(spark, sf_dir):
    path = _work(spark, "bronze")
    sinks.write_bronze(_snapshots(spark, sf_dir), path)
    return flatten.flatten_snapshots(spark.read.parquet(path))


def q_raw_archive_roundtrip(spark, sf_dir):
    """Raw documents by local capture date; documents and rows of every date."""
    path = _work(spark, "archive")
    docs = _snapshots(spark, sf_dir).withColumnRenamed("capture_minute", "captured_at")
    sinks.archive_raw(docs, path, tz=TZ)
    back = read_snapshots(spark, path).withColumn("day", F.regexp_extract(
        F.col("_metadata.file_path"), "capture_date=([0-9_]+)", 1))
    return back.groupBy("day").agg(F.count(F.lit(1)).alias("documents"),
                                   F.sum(F.size("records").cast("bigint")).alias("station_rows"))


def q_timemap_csv_roundtrip(spark, sf_dir):
    path = _work(spark, "timemap")
    records, stations = _model(spark, sf_dir)
    sinks.write_timemap_csv(frames.timemap_frames(frames.timemap_rows(records, stations)), path)
    back = sinks.read_timemap_csv(spark, path)
    return back.groupBy("time_index").agg(F.count(F.lit(1)).alias("rows"),
                                          F.sum("nb_velos_dispo").alias("bikes")).orderBy("time_index")


def q_load_report(spark, sf_dir):
    """Documents of which some lines are cut off, some are empty and some ids are bad."""
    path = _work(spark, "damaged")
    minute = F.floor(F.unix_seconds("capture_minute") / 60)
    empty = F.lit(None).cast(_snapshots(spark, sf_dir).schema["records"].dataType)

    def damaged(r):
        libelle = r["fields"]["libelle"]
        return r.withField("fields", r["fields"].withField(
            "libelle", F.when(libelle.cast("bigint") % 10 == 3, F.concat(F.lit("x"), libelle)).otherwise(libelle)))

    docs = _snapshots(spark, sf_dir)
    line = F.to_json(F.struct("nhits", F.when(minute % 13 == 1, empty).otherwise(
        F.transform("records", damaged)).alias("records")))
    cut = F.when(minute % 17 == 0, F.substring(line, F.lit(1), F.length(line) - 9)).otherwise(line)
    docs.select(cut.alias("value")).write.text(path)
    return flatten.load_report(read_snapshots(spark, path, keep_corrupt=True))


def q_replace_with_concurrent_writers(spark, sf_dir):
    """A window is replaced while another writer appends the readings of its first day again and
    a reader has begun: the reader's rows, and the table's rows afterwards."""
    table = f"{_work(spark, 'concurrent')}/records"
    records = _records(spark, sf_dir)
    dated.append(sinks.with_record_date(records), table)
    before = dated.read(spark, table)
    first_day = time_range(records, *FIRST_DAY)
    halved = records.withColumn("nb_available_bikes", F.expr("nb_available_bikes div 2"))
    calls = []

    def build(stored):
        if not calls:  # once, after the table was read
            sinks.append_records(first_day, table)
        calls.append(1)
        inside = (F.col("record_timestamp") >= ts_literal(REPLACED[0])) & (F.col("record_timestamp") < ts_literal(REPLACED[1]))
        kept = stored.where(F.col(RECORD_DATE).isin(days)).where(~inside).select(*RECORD_COLUMNS)
        return sinks.with_record_date(kept.unionByName(halved.where(inside)))

    days = touched_dates(*REPLACED)
    dated.replace(spark, table, days, build)
    after = dated.read(spark, table)
    return (before.select(F.lit("before").alias("seen"), *RECORD_COLUMNS)
            .unionByName(after.select(F.lit("after").alias("seen"), *RECORD_COLUMNS)))


def q_load_by_ledger(spark, sf_dir):
    """A folder is loaded in batches of three files, then again, then with more files; the table
    holds every record once."""
    work = _work(spark, "ledger")
    table, raw, book = (f"{work}/{n}" for n in ("records", "raw", "ledger"))
    docs, late = _snapshots(spark, sf_dir), F.col("capture_minute") >= F.lit(dt.datetime(2024, 1, 16))
    sinks.write_snapshots_json(docs.where(~late).drop("capture_minute").repartition(8), f"{raw}/first")
    ledger.load_new(spark, raw, table, book, max_files=3)
    ledger.load_new(spark, raw, table, book)
    sinks.write_snapshots_json(docs.where(late).drop("capture_minute"), f"{raw}/second")
    ledger.load_new(spark, raw, table, book)
    return dated.read(spark, table).select(*RECORD_COLUMNS)


def q_ledger_report(spark, sf_dir):
    """What the ledger says of two loads: documents and rows by folder; files changed since."""
    work = _work(spark, "ledger")
    table, raw, book = (f"{work}/{n}" for n in ("records", "raw", "ledger"))
    docs, late = _snapshots(spark, sf_dir), F.col("capture_minute") >= F.lit(dt.datetime(2024, 1, 16))
    sinks.write_snapshots_json(docs.where(~late).drop("capture_minute"), f"{raw}/first")
    ledger.load_new(spark, raw, table, book)
    sinks.write_snapshots_json(docs.where(late).drop("capture_minute"), f"{raw}/second")
    ledger.load_new(spark, raw, table, book)
    changed = ledger.changed_files(spark, raw, book).agg(F.count(F.lit(1)).alias("changed_files"))
    folder = F.regexp_extract("path", "/raw/([a-z]+)/", 1).alias("folder")
    loaded = ledger.loaded_files(spark, book).groupBy(folder).agg(*[F.sum(c).alias(c) for c in ledger.COUNTS])
    return loaded.select("*", changed.scalar().alias("changed_files"))


def _streamed_transactions(reverse: bool):
    def query(spark, sf_dir):
        work = _work(spark, "stream-transactions")
        docs = _snapshots(spark, sf_dir).withColumn("part", F.dayofmonth("capture_minute") % 3)
        for part in sorted(range(3), reverse=reverse):  # three loads that take turns in every three days
            sinks.write_snapshots_json(docs.where(F.col("part") == part).drop("capture_minute", "part"), f"{work}/part-{part}")
            sinks.write_snapshots_json(spark.read.schema(SNAPSHOT).json(f"{work}/part-{part}"), f"{work}/raw", mode="append")
            # Every load is a batch, however many files it has; the stream goes on from its checkpoint.
            transactions_stream(spark, f"{work}/raw", f"{work}/hours", f"{work}/_checkpoint", TZ, lateness="60 days",
                                available_now=True).awaitTermination()
        kept = kept_transactions(spark, f"{work}/hours")
        return kept.select(_day_text(), "hour_of_day", "borrowed", "returned")
    return query


def q_rollup_profile(spark, sf_dir):
    """Partials kept up over two loads, a replacement and a repair; the profile of all dates."""
    return rollups.kept_profile(spark, _kept(spark, sf_dir)[1])


def q_rollup_network(spark, sf_dir):
    return rollups.kept_totals(spark, _kept(spark, sf_dir)[1]).select("record_timestamp", "total_bikes", "readings")


def _kept(spark, sf_dir) -> tuple[str, str]:
    work = _work(spark, "rollups")
    table, kept = f"{work}/records", f"{work}/rollups"
    records, middle = _records(spark, sf_dir), F.lit(dt.datetime(2024, 1, 12, 7, 30))
    wrong = records.withColumn("nb_available_bikes", F.col("nb_available_bikes") + 100)
    rollups.append_kept(wrong.where(F.col("record_timestamp") < middle), table, kept)
    rollups.append_kept(records.where(F.col("record_timestamp") >= middle), table, kept)
    rollups.replace_kept(spark, records, table, kept, *BEFORE)
    rollups.repair_kept(spark, table, kept, *REPAIR_WINDOW)
    return table, kept


def q_value_ranges(spark, sf_dir):
    """Validity ranges of the bikes of every station, cut at midnight."""
    ranges = intervals.value_ranges(_records(spark, sf_dir), ["station_id"], ["nb_available_bikes"])
    return ranges.withColumn(intervals.DAY, F.date_format(intervals.DAY, "yyyy-MM-dd"))


def q_value_at(spark, sf_dir):
    """Bikes of the next station, 37 minutes after each reading."""
    records = _records(spark, sf_dir)
    ranges = intervals.value_ranges(records, ["station_id"], ["nb_available_bikes"])
    points = records.select((F.col("station_id") + 1).alias("station_id"),
                            (F.col("record_timestamp") + F.make_dt_interval(mins=F.lit(37))).alias("at"))
    return intervals.value_at(points, ranges, ["station_id"], ["nb_available_bikes"])


def q_minutes_on_demand(spark, sf_dir):
    """Two hours of the dense series of every station, made from the ranges."""
    ranges = intervals.value_ranges(_records(spark, sf_dir), ["station_id"], ["nb_available_bikes"])
    return intervals.minutes_between(ranges, *TWO_HOURS, ["station_id"], ["nb_available_bikes"])


# --------------------------------------------------------------------------- clock changes

def _shifted(spark, sf_dir, query) -> DataFrame:
    out = None
    for days in SHIFTS:
        move = F.make_dt_interval(days=F.lit(days))
        records = (_records(spark, sf_dir).withColumn("record_timestamp", F.col("record_timestamp") + move)
                   .withColumn("last_update", F.col("last_update") + move))
        part = query(records).withColumn("moved_days", F.lit(days))
        out = part if out is None else out.unionByName(part)
    return out


def q_transactions_dst(spark, sf_dir):
    t = _shifted(spark, sf_dir, lambda r: transactions.transactions_by_hour(r, TZ))
    return t.select("moved_days", _day_text(), "hour_of_day", "borrowed", "returned")


def q_timeline_dst(spark, sf_dir):
    t = _shifted(spark, sf_dir, lambda r: dashboard.network_timeline(r, span=None, tz=TZ, band=BAND, daily=True))
    return t.select("moved_days", _day_text(), "minute", "local_minute", "total_bikes")


def q_animation_frames_dst(spark, sf_dir):
    _, stations = _model(spark, sf_dir)
    e = _shifted(spark, sf_dir, lambda r: frames.frame_entries(frames.frame_points(r, stations, tz=TZ), TZ))
    return e.select("moved_days", "minute", "local_minute", "observed_minute", "station_id", "record_timestamp",
                    "taux_velos_dispo")


# --------------------------------------------------------------------------- uneven data

def _uneven(spark, sf_dir) -> DataFrame:
    """Every seventh event has no bikes, every eleventh no places; times are cut to the
    hour, so readings of a station share them and only ``last_update`` tells their order."""
    e = testdata.load_table(spark, sf_dir, "events")
    r = testdata.records_from_events(e.withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
                                     .withColumn("props", F.when(F.col("event_id") % 11 != 0, F.col("props"))))
    return r.withColumn("record_timestamp", F.date_trunc("hour", "record_timestamp"))


def q_network_kpis_uneven(spark, sf_dir):
    return network.network_kpis(network.latest_readings(_uneven(spark, sf_dir)))


def q_realtime_uneven(spark, sf_dir):
    return network.latest_readings(_uneven(spark, sf_dir)).select(*RECORD_COLUMNS)


def q_station_delta_uneven(spark, sf_dir):
    d = transactions.station_deltas(_uneven(spark, sf_dir), TZ)
    return d.select("station_id", "record_timestamp", _day_text(), "hour_of_day", "transaction_value")


def q_minute_first_uneven(spark, sf_dir):
    return minute_first(_uneven(spark, sf_dir), ["station_id"], "record_timestamp",
                        ["nb_available_bikes", "nb_available_places"], tiebreak=["last_update"])


def q_network_timeline_snapshots(spark, sf_dir):
    """Full hourly snapshots: every station's readings of an hour share their time."""
    t = dashboard.network_timeline(_uneven(spark, sf_dir), span=None, tz=TZ, band=(10, 100_000), pad=None)
    return t.select("minute", "local_minute", "total_bikes")


# --------------------------------------------------------------------------- single charts

def _span(span):
    def query(spark, sf_dir):
        t = dashboard.station_timeline(_records(spark, sf_dir), STATION, span, KPI_NOW, TZ)
        return t.select("minute", "local_minute", "nb_available_bikes")
    return query


def q_network_timeline_7d(spark, sf_dir):
    return dashboard.network_timeline(_records(spark, sf_dir), "7d", KPI_NOW, TZ, BAND)


def q_hourly_profile_station_weekday(spark, sf_dir):
    return network.hourly_profile(_records(spark, sf_dir), SERVICE_START, NOW, station=STATION, weekday=WEEKDAY)


def q_chart_series_arrays(spark, sf_dir):
    """One chart a local day, never longer than the day: labels and values as text."""
    series = dashboard.network_series(_records(spark, sf_dir), BAND).withColumn(
        "local_date", local_date("record_timestamp", TZ))
    first = minute_first(series, ["local_date"], "record_timestamp", ["total_bikes"])
    packed = dashboard.chart_series(first.withColumn("label", F.date_format(local_time("minute", TZ), "HH:mm")),
                                    ["local_date"], "minute", "label", ["total_bikes"])
    return packed.select(_day_text(), F.array_join("labels", ",").alias("labels"),
                         F.array_join(F.col("values").cast("array<string>"), ",").alias("series"))


def q_animation_frames_packed(spark, sf_dir):
    """Packed frames: label, and how many entries each of the parallel arrays has."""
    records, stations = _model(spark, sf_dir)
    packed = frames.animation_frames(records, stations, tz=TZ)
    return packed.select("minute", *[F.size(c).alias(f"n_{c}") for c in packed.columns[1:]],
                         F.round(F.aggregate("latitude", F.lit(0.0), lambda a, x: a + x), 6).alias("sum_latitude"))


def q_realtime_lookup(spark, sf_dir):
    """Readings of one station by its id as text, letters in any case."""
    docs = _snapshots(spark, sf_dir)
    named = docs.withColumn("records", F.transform("records", lambda r: r.withField("fields", r["fields"].withField(
        "libelle", F.concat(F.lit("Station-"), r["fields"]["libelle"])))))
    rows = flatten.flatten_realtime(named, strict=False).where(F.lower("libelle") == f"station-{STATION}")
    return rows.select("libelle", "name", "nb_available_bikes", "record_timestamp")


QUERIES = {
    "load_window_replace": q_load_window_replace,
    "stream_then_repair": q_stream_then_repair,
    "replace_with_concurrent_writers": q_replace_with_concurrent_writers,
    "load_by_ledger": q_load_by_ledger,
    "ledger_report": q_ledger_report,
    "stream_transactions": _streamed_transactions(reverse=False),
    "stream_transactions_out_of_order": _streamed_transactions(reverse=True),
    "rollup_profile": q_rollup_profile,
    "rollup_network": q_rollup_network,
    "value_ranges": q_value_ranges,
    "value_at": q_value_at,
    "minutes_on_demand": q_minutes_on_demand,
    "index_kpis_latest": q_index_kpis_latest,
    "table_backup_roundtrip": q_table_backup_roundtrip,
    "bronze_roundtrip": q_bronze_roundtrip,
    "raw_archive_roundtrip": q_raw_archive_roundtrip,
    "timemap_csv_roundtrip": q_timemap_csv_roundtrip,
    "load_report": q_load_report,
    "transactions_dst": q_transactions_dst,
    "timeline_dst": q_timeline_dst,
    "animation_frames_dst": q_animation_frames_dst,
    "network_kpis_uneven": q_network_kpis_uneven,
    "realtime_uneven": q_realtime_uneven,
    "station_delta_uneven": q_station_delta_uneven,
    "minute_first_uneven": q_minute_first_uneven,
    "network_timeline_snapshots": q_network_timeline_snapshots,
    "station_timeline_today": _span("today"),
    "station_timeline_24h": _span("24h"),
    "station_timeline_7d": _span("7d"),
    "network_timeline_7d": q_network_timeline_7d,
    "hourly_profile_station_weekday": q_hourly_profile_station_weekday,
    "chart_series_arrays": q_chart_series_arrays,
    "animation_frames_packed": q_animation_frames_packed,
    "realtime_lookup": q_realtime_lookup,
}


# --------------------------------------------------------------------------- oracles

def _moved(days: int) -> str:
    return _RECORDS.replace("ts AS last_update", f"ts + INTERVAL {days} DAY AS last_update").replace(
        "ts AS record_timestamp", f"ts + INTERVAL {days} DAY AS record_timestamp")


def _both(sql) -> str:
    """``sql(days)`` for both shifts, as one result."""
    return "\nUNION ALL\n".join(f"SELECT {days} AS moved_days, * FROM ({sql(days)})" for days in SHIFTS)


_UNEVEN = _RECORDS.replace("floor(value)", "floor(CASE WHEN event_id % 7 <> 0 THEN value END)").replace(
    "props->>'k'", "CASE WHEN event_id % 11 <> 0 THEN props END->>'k'").replace(
    "ts AS record_timestamp", "date_trunc('hour', ts) AS record_timestamp")

_ALL_DELTAS = f"""c AS (
  SELECT station_id, record_timestamp, CAST({_local('record_timestamp')} AS DATE) AS local_date,
         CAST(hour({_local('record_timestamp')}) AS INTEGER) AS hour_of_day,
         lag(nb_available_bikes) OVER (PARTITION BY station_id, CAST({_local('record_timestamp')} AS DATE)
                                       ORDER BY record_timestamp, last_update) - nb_available_bikes AS v
  FROM records WHERE station_id IS NOT NULL AND record_timestamp IS NOT NULL)"""


_RANGES = """first AS (
  SELECT station_id, date_trunc('minute', record_timestamp) AS minute,
         arg_min(nb_available_bikes, record_timestamp) FILTER (nb_available_bikes IS NOT NULL) AS nb_available_bikes
  FROM records WHERE record_timestamp IS NOT NULL GROUP BY 1, 2),
spans AS (
  SELECT *, coalesce(lead(minute) OVER (PARTITION BY station_id ORDER BY minute), minute + INTERVAL 1 MINUTE) AS till
  FROM first),
cut AS (
  SELECT *, CAST(unnest(generate_series(date_trunc('day', minute), till - INTERVAL 1 MINUTE, INTERVAL 1 DAY)) AS DATE) AS d
  FROM spans),
ranges AS (
  SELECT station_id, d AS range_date, greatest(minute, d::TIMESTAMP) AS valid_from,
         least(till, d::TIMESTAMP + INTERVAL 1 DAY) AS valid_to, nb_available_bikes
  FROM cut)"""


def _repaired(sql: str) -> str:
    """``sql`` over ``fixed``, the rows that the oracle of the repair gives."""
    return "WITH fixed AS (" + _BASE["repair_window"] + ")" + sql


def _lower(span: str) -> str:
    return {"today": "TIMESTAMP '2024-01-29 23:00:00'", "24h": "TIMESTAMP '2024-01-29 18:00:00'",
            "7d": "TIMESTAMP '2024-01-22 23:00:00'"}[span]


def _station_span(span: str) -> str:
    return _with(_RECORDS, f"""src AS (
  SELECT * FROM records WHERE station_id = {STATION} AND record_timestamp >= {_lower(span)})""",
                 _fill("src", ["station_id"], "nb_available_bikes", "filled"),
                 _pad("filled", ["station_id"], "nb_available_bikes", "BIGINT", "padded")) + f"""
SELECT minute, {_local('minute')} AS local_minute, nb_available_bikes FROM padded"""


_FRAMES = """pts AS (
  SELECT date_trunc('minute', record_timestamp) AS minute, station_id, record_timestamp, latitude, longitude,
         nb_available_bikes / nullif(nb_available_bikes + nb_available_places, 0) AS taux_velos_dispo
  FROM records JOIN stations ON stations.id = records.station_id
  WHERE operational_state = 'EN SERVICE'),
mins AS (SELECT DISTINCT minute FROM pts),
spans AS (
  SELECT minute, coalesce(lead(minute) OVER (ORDER BY minute) - INTERVAL 1 MINUTE, minute) AS last FROM mins),
entries AS (
  SELECT unnest(generate_series(p.minute, s.last, INTERVAL 1 MINUTE)) AS minute, p.minute AS observed_minute,
         p.station_id, p.record_timestamp, p.latitude, p.taux_velos_dispo
  FROM pts p JOIN spans s ON s.minute = p.minute)"""

_DAY_NET = f"""netd AS (SELECT CAST({_local('record_timestamp')} AS DATE) AS local_date, * FROM net)"""

ORACLE_SQL = {
    "load_window_replace": _with(_RECORDS) + f"""
SELECT * REPLACE (CASE WHEN record_timestamp >= {_ts(REPLACED[0])} AND record_timestamp < {_ts(REPLACED[1])}
                       THEN nb_available_bikes ELSE nb_available_bikes + 100 END AS nb_available_bikes)
FROM records""",

    "stream_then_repair": _BASE["repair_window"].replace("WITH records AS (", "WITH once AS (", 1).replace(
        "kept AS (", """records AS (
  SELECT * FROM once WHERE station_id IS NOT NULL UNION ALL SELECT * FROM once),
kept AS (""", 1),

    "replace_with_concurrent_writers": _with(_RECORDS) + f"""
SELECT 'before' AS seen, * FROM records
UNION ALL
SELECT 'after' AS seen, * REPLACE (CASE WHEN record_timestamp >= {_ts(REPLACED[0])} AND record_timestamp < {_ts(REPLACED[1])}
                                        THEN nb_available_bikes // 2 ELSE nb_available_bikes END AS nb_available_bikes)
FROM records
UNION ALL
SELECT 'after' AS seen, * FROM records
WHERE record_timestamp >= {_ts(FIRST_DAY[0])} AND record_timestamp < {_ts(REPLACED[0])}""",

    "load_by_ledger": _with(_RECORDS) + "SELECT * FROM records",

    "ledger_report": _with(_RECORDS) + """
SELECT CASE WHEN record_timestamp >= TIMESTAMP '2024-01-16' THEN 'second' ELSE 'first' END AS folder,
       count(DISTINCT (date_trunc('minute', record_timestamp), floor(station_id / 300))) AS documents,
       0 AS corrupt, 0 AS empty, count(*) AS station_rows, 0 AS bad_ids, count(*) AS loaded_rows, 0 AS changed_files
FROM records GROUP BY 1""",

    "stream_transactions": _BASE["transactions_by_hour"],
    "stream_transactions_out_of_order": _BASE["transactions_by_hour"],

    "rollup_profile": _repaired("""
SELECT station_id, CAST(dayofweek(record_timestamp) + 1 AS INTEGER) AS day_of_week,
       CAST(hour(record_timestamp) AS INTEGER) AS hour_of_day, avg(nb_available_bikes) AS avg_nb_available_bikes
FROM fixed WHERE record_timestamp IS NOT NULL GROUP BY 1, 2, 3"""),

    "rollup_network": _repaired("""
SELECT record_timestamp, CAST(sum(nb_available_bikes) AS BIGINT) AS total_bikes, count(*) AS readings
FROM fixed WHERE record_timestamp IS NOT NULL GROUP BY 1"""),

    "value_ranges": _with(_RECORDS, _RANGES) + """
SELECT * REPLACE (strftime(range_date, '%Y-%m-%d') AS range_date) FROM ranges""",

    "value_at": _with(_RECORDS, _RANGES, """points AS (
  SELECT station_id + 1 AS station_id, record_timestamp + INTERVAL 37 MINUTE AS at FROM records)""") + """
SELECT p.station_id, p.at, r.nb_available_bikes
FROM points p LEFT JOIN ranges r ON r.station_id = p.station_id AND p.at >= r.valid_from AND p.at < r.valid_to""",

    "minutes_on_demand": _with(_RECORDS, _fill("records", ["station_id"], "nb_available_bikes", "filled")) + f"""
SELECT station_id, minute, nb_available_bikes FROM filled
WHERE minute >= {_ts(TWO_HOURS[0])} AND minute < {_ts(TWO_HOURS[1])}""",

    "index_kpis_latest": _BASE["index_kpis"],

    "table_backup_roundtrip": _with(_RECORDS) + "SELECT * FROM records",

    "bronze_roundtrip": _with(_RECORDS) + "SELECT * FROM records",

    "raw_archive_roundtrip": _with(_RECORDS) + f"""
SELECT strftime({_local("date_trunc('minute', record_timestamp)")}, '%Y_%m_%d') AS day,
       count(DISTINCT (date_trunc('minute', record_timestamp), floor(station_id / 300))) AS documents,
       count(*) AS station_rows
FROM records GROUP BY 1""",

    "timemap_csv_roundtrip": "SELECT time_index, count(*) AS rows, CAST(sum(nb_velos_dispo) AS BIGINT) AS bikes FROM ("
                             + _BASE["timemap_frames"] + ") GROUP BY time_index ORDER BY time_index",

    "load_report": _with(_RECORDS, """docs AS (
  SELECT date_trunc('minute', record_timestamp) AS capture, floor(station_id / 300) AS page, count(*) AS n,
         count_if(station_id % 10 = 3) AS bad
  FROM records GROUP BY ALL),
kinds AS (
  SELECT *, (epoch(capture) // 60) % 17 = 0 AS broken, (epoch(capture) // 60) % 13 = 1 AS hollow FROM docs)""") + """
SELECT count(*) AS documents, count_if(broken) AS corrupt, count_if(hollow AND NOT broken) AS empty,
       CAST(coalesce(sum(n) FILTER (NOT broken AND NOT hollow), 0) AS BIGINT) AS station_rows,
       CAST(coalesce(sum(bad) FILTER (NOT broken AND NOT hollow), 0) AS BIGINT) AS bad_ids,
       CAST(coalesce(sum(n - bad) FILTER (NOT broken AND NOT hollow), 0) AS BIGINT) AS loaded_rows
FROM kinds""",

    "transactions_dst": _both(lambda days: _BASE["transactions_by_hour_padded"].replace(_RECORDS, _moved(days))),

    "timeline_dst": _both(lambda days: _BASE["network_day_timeline"].replace(_RECORDS, _moved(days))),

    "animation_frames_dst": _both(lambda days: _with(_moved(days), _STATIONS, _FRAMES) + f"""
SELECT minute, {_local('minute')} AS local_minute, observed_minute, station_id, record_timestamp, taux_velos_dispo
FROM entries"""),

    "network_kpis_uneven": _with(_UNEVEN, _LATEST) + f"SELECT {_KPIS}\nFROM latest",

    "realtime_uneven": _with(_UNEVEN, _LATEST) + "SELECT * FROM latest",

    "station_delta_uneven": _with(_UNEVEN, _ALL_DELTAS) + """
SELECT station_id, record_timestamp, strftime(local_date, '%Y-%m-%d') AS local_date, hour_of_day,
       v AS transaction_value FROM c WHERE v IS NOT NULL AND v <> 0""",

    "minute_first_uneven": _with(_UNEVEN) + """
SELECT station_id, date_trunc('minute', record_timestamp) AS minute,
       first(nb_available_bikes ORDER BY record_timestamp, last_update) FILTER (nb_available_bikes IS NOT NULL)
           AS nb_available_bikes,
       first(nb_available_places ORDER BY record_timestamp, last_update) FILTER (nb_available_places IS NOT NULL)
           AS nb_available_places
FROM records GROUP BY 1, 2""",

    "network_timeline_snapshots": _with(_UNEVEN, _NET.replace(f"> {BAND[0]}", "> 10").replace(f"< {BAND[1]}", "< 100000"),
                                        _fill("net", [], "total_bikes", "filled")) + f"""
SELECT minute, {_local('minute')} AS local_minute, total_bikes FROM filled""",

    "station_timeline_today": _station_span("today"),
    "station_timeline_24h": _station_span("24h"),
    "station_timeline_7d": _station_span("7d"),

    "network_timeline_7d": _with(_RECORDS.replace("FROM events)", f"FROM events WHERE ts >= {_lower('7d')})"), _NET,
                                 _fill("net", [], "total_bikes", "filled"),
                                 _pad("filled", [], "total_bikes", "BIGINT", "padded")) + f"""
SELECT minute, {_local('minute')} AS local_minute, total_bikes FROM padded""",

    "hourly_profile_station_weekday": "SELECT * FROM (" + _BASE["weekday_hour_profile"]
                                      + f") WHERE station_id = {STATION} AND day_of_week = 2 ORDER BY hour_of_day",

    "chart_series_arrays": _with(_RECORDS, _NET, _DAY_NET, """first AS (
  SELECT local_date, date_trunc('minute', record_timestamp) AS minute, arg_min(total_bikes, record_timestamp) AS total_bikes
  FROM netd GROUP BY ALL)""") + f"""
SELECT strftime(local_date, '%Y-%m-%d') AS local_date,
       string_agg(strftime({_local('minute')}, '%H:%M'), ',' ORDER BY minute) AS labels,
       string_agg(CAST(total_bikes AS VARCHAR), ',' ORDER BY minute) AS series
FROM first GROUP BY local_date""",

    "animation_frames_packed": _with(_RECORDS, _STATIONS, _FRAMES) + f"""
SELECT strftime({_local('minute')}, '%Y-%m-%d %H:%M') AS minute, CAST(count(*) AS INTEGER) AS n_latitude,
       CAST(count(*) AS INTEGER) AS n_longitude, CAST(count(*) AS INTEGER) AS n_taux_velos_dispo,
       round(sum(latitude), 6) AS sum_latitude
FROM entries GROUP BY {_local('minute')}, entries.minute""",

    "realtime_lookup": _with(_RECORDS, _STATIONS) + f"""
SELECT 'Station-' || station_id AS libelle, name, nb_available_bikes, record_timestamp
FROM records LEFT JOIN stations ON stations.id = records.station_id WHERE station_id = {STATION}""",
}
