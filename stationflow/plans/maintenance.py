"""Stored fact table maintenance: window loads and dead-data repair.

The fact table is a dated table (``sources.dated``): the new content of the dates that a load
or a repair touches becomes visible at one instant, a failure before leaves the old table,
and rows that the stream or another load appends meanwhile are kept.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.timefn import to_utc_datetime, ts_literal
from stationflow.operators.flatten import latest_per_key, load_report, rejects
from stationflow.operators.repair import WEEK, backfill, repair_window, touched_dates
from stationflow.schemas import RECORD_COLUMNS, RECORD_DATE, RECORDS, SNAPSHOT_FOR_RECORDS
from stationflow.session import delete_path, path_exists
from stationflow.sources import dated, sinks
from stationflow.sources.snapshots import CORRUPT, read_snapshots


class Rejected(ValueError):
    """A load has rejects and no place to keep them."""


def load_window(spark: SparkSession, raw_paths: str | Sequence[str], fact_path: str, start, end,
                replace: bool = False, strict: bool = True,
                quarantine_path: str | None = None) -> DataFrame:
    """Raw snapshots → records of ``[start, end)`` → the fact table; returns the load report
    (``flatten.load_report``).

    ``replace=False`` appends (re-running duplicates rows, as a plain INSERT does);
    ``replace=True`` puts the load in the place of the stored rows of the window, so that
    it can be run again. Stored rows outside it, and stored rows without a timestamp, stay.
    ``strict`` fails on a station id that is no whole number; otherwise such records are left
    out. All rejects are written to ``quarantine_path``; without it, a cut-off line or (not
    strict) a bad id fails the load before it writes, as in the stream."""
    docs = read_snapshots(spark, raw_paths, schema=SNAPSHOT_FOR_RECORDS, keep_corrupt=True)
    keep_rejects(docs, strict, quarantine_path)
    rows = backfill(docs.where(F.col(CORRUPT).isNull()), start, end, strict)
    dated.adopt(spark, fact_path)
    if replace and dated.exists(spark, fact_path):
        replace_window(spark, rows, fact_path, start, end)
    else:
        dated.append(sinks.with_record_date(rows), fact_path)
    return load_report(docs)


def keep_rejects(docs: DataFrame, strict: bool, quarantine_path: str | None, what: str = "the load") -> None:
    """Write what can't be loaded to ``quarantine_path``; without it, fail if there is anything
    but empty documents. In a strict load a bad id fails the load itself."""
    if quarantine_path:
        refused = rejects(docs).where(F.lit(not strict) | (F.col("reason") != "bad_id"))
        refused.write.mode("overwrite").json(quarantine_path)
        return
    report = load_report(docs).first()
    if report.corrupt or (not strict and report.bad_ids):
        raise Rejected(f"{what} has rejects; give quarantine_path to keep them")


def replace_window(spark: SparkSession, rows: DataFrame, fact_path: str, start, end) -> int:
    """Put ``rows`` in the place of the stored rows of ``[start, end)``; returns the table's new
    version. Of rows without a timestamp those are added that aren't stored yet (each as
    often as it comes), so that a repeated load changes nothing."""
    days = touched_dates(start, end)
    ts = F.col("record_timestamp")
    inside = (ts >= ts_literal(start)) & (ts < ts_literal(end))
    fresh = rows.select(*RECORD_COLUMNS)

    def build(stored: DataFrame) -> DataFrame:
        kept = stored.where(F.col(RECORD_DATE).between(days[0], days[-1])).where(~inside).select(*RECORD_COLUMNS)
        timeless = stored.where(F.col(RECORD_DATE).isNull()).select(*RECORD_COLUMNS)
        new = fresh.where(ts.isNull()).exceptAll(timeless)
        return sinks.with_record_date(kept.unionByName(fresh.where(inside)).unionByName(timeless).unionByName(new))

    return dated.replace(spark, fact_path, [*days, None], build)


def repair_stored(spark: SparkSession, fact_path: str, start, end, shift: dt.timedelta = WEEK,
                  backup_path: str | None = None) -> list[dt.date]:
    """Apply ``repair_window`` to the stored table; returns the rewritten dates."""
    lo, hi = to_utc_datetime(start), to_utc_datetime(end)
    touched = touched_dates(lo, hi)
    source = touched_dates(lo - shift, hi - shift)
    dated.adopt(spark, fact_path)
    if backup_path:
        (dated.read(spark, fact_path).where(F.col(RECORD_DATE).isin(touched)).write.mode("errorifexists")
         .partitionBy(RECORD_DATE).parquet(backup_path))

    def build(stored: DataFrame) -> DataFrame:
        part = stored.where(F.col(RECORD_DATE).isin(touched + source)).drop(RECORD_DATE)
        fixed = repair_window(part, lo, hi, shift).where(F.to_date("record_timestamp").isin(touched))
        return sinks.with_record_date(fixed)

    dated.replace(spark, fact_path, touched, build)
    return touched


def merge_latest(spark: SparkSession, records: DataFrame, path: str) -> None:
    """Keep the table of the latest reading of every station current: ``records`` are merged
    by time, so late ones don't replace newer ones and no station is lost however old its
    last reading is. Each merge writes a new version; the newest complete one counts."""
    versions = _versions(spark, path)
    known = records.select(*RECORD_COLUMNS).where("station_id is not null and record_timestamp is not null")
    if versions:
        known = known.unionByName(read_latest(spark, path))
    latest = latest_per_key(known, "station_id", ["record_timestamp", "last_update"])
    latest.select(*RECORD_COLUMNS).write.mode("overwrite").parquet(
        f"{path}/version={(versions[-1] if versions else 0) + 1}")
    for old in versions[:-1]:  # the one before stays for readers that have begun
        delete_path(spark, f"{path}/version={old}")


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """One row per station: its latest reading."""
    return spark.read.schema(RECORDS).parquet(f"{path}/version={_versions(spark, path)[-1]}")


def _versions(spark: SparkSession, path: str) -> list[int]:
    if not path_exists(spark, path):
        return []
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    names = [f.getPath().getName() for f in found]
    return sorted(int(n.partition("=")[2]) for n in names
                  if n.startswith("version=") and path_exists(spark, f"{path}/{n}/_SUCCESS"))
