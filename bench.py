"""Benchmark: headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

(a) raw snapshot JSON → unnest → date-partitioned Parquet (documents/s, rows/s);
(b) each dashboard operator over the stored fact table, forced to run in full
    with a no-op write (nothing is collected).
Prints one JSON line.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from stationflow.functions.timefn import local_day_bounds  # noqa: E402
from stationflow.operators import frames, network, repair, transactions  # noqa: E402
from stationflow.operators.filters import time_range  # noqa: E402
from stationflow.operators.flatten import flatten_snapshots  # noqa: E402
from stationflow.operators.timeaxis import minute_fill, minute_first  # noqa: E402
from stationflow.schemas import RECORD_COLUMNS, SNAPSHOT_FOR_RECORDS  # noqa: E402
from stationflow.plans import dashboard  # noqa: E402
from stationflow.session import build_session, scratch_path  # noqa: E402
from stationflow.sources import sinks, testdata  # noqa: E402
from stationflow.sources.snapshots import read_snapshots  # noqa: E402

TZ = "Europe/Paris"
NOW = dt.datetime(2024, 1, 31)
START = dt.datetime(2024, 1, 1)
DAY = dt.date(2024, 1, 15)
REPEATS = 3
VALUES = ["operational_state", "nb_available_bikes", "nb_available_places", "connexion",
          "last_update"]


def dense_day(records, day: dt.date):
    """Every station's state at every minute of one local day, the shape of the
    real feed (one snapshot per minute holding every station)."""
    lo, hi = local_day_bounds(day, TZ)
    r = time_range(records, lo, hi).where(F.col("station_id").isNotNull())
    filled = minute_fill(minute_first(r, ["station_id"], "record_timestamp", VALUES),
                         ["station_id"], VALUES)
    return filled.withColumnRenamed("minute", "record_timestamp").select(*RECORD_COLUMNS)


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app_name="stationflow-bench",
                          shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.ui.enabled": "false", "spark.driver.memory": "16g",
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="stationflow-"),
                                 "spark.ui.showConsoleProgress": "false",
                                 "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    spark.sparkContext.setLogLevel("ERROR")
    work = scratch_path(spark, f"bench-{uuid.uuid4().hex[:8]}")
    raw_dir, fact_dir = os.path.join(work, "raw"), os.path.join(work, "records")

    dense_dir = os.path.join(work, "raw_dense")
    # Untimed preparation: raw snapshot documents as JSON lines, as the feed
    # delivers them: (1) every reading of the month, nested per minute and page;
    # (2) one day of the full network state, one document per minute and page.
    records, stations = testdata.load_model(spark, sf_dir)
    docs = testdata.snapshots_from_records(records, stations).drop("capture_minute")
    sinks.write_snapshots_json(docs, raw_dir)
    dense = testdata.snapshots_from_records(dense_day(records, DAY), stations)
    sinks.write_snapshots_json(dense.drop("capture_minute"), dense_dir)
    _run(records)  # warm-up

    timings: dict[str, float] = {}

    def timed(name, fn):
        """Median of REPEATS runs after one that compiles the code."""
        took = []
        for _ in range(1 + REPEATS):
            t0 = time.perf_counter()
            fn()
            took.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(took[1:]), 3)

    # (a) load: JSON → unnest → cast → window → partitioned Parquet
    def load():
        snaps = read_snapshots(spark, raw_dir, schema=SNAPSHOT_FOR_RECORDS)
        sinks.overwrite_records(repair.backfill(snaps, START, NOW), fact_dir)
    timed("ingest_json_to_parquet", load)
    load_report = read_snapshots(spark, raw_dir).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.size("records")).alias("rows")).first()

    def load_dense():
        snaps = read_snapshots(spark, dense_dir, schema=SNAPSHOT_FOR_RECORDS)
        sinks.overwrite_records(repair.backfill(snaps, START, NOW), os.path.join(work, "dense"))
    timed("ingest_dense_day", load_dense)
    dense_report = read_snapshots(spark, dense_dir).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.size("records")).alias("rows")).first()

    # (b) the same from one file for each document, as the feed is archived.
    tiny_dir = os.path.join(work, "raw_tiny")
    read_snapshots(spark, dense_dir).write.option("maxRecordsPerFile", 1).json(tiny_dir)
    files = read_snapshots(spark, tiny_dir).select(F.count_distinct("_metadata.file_path")).first()[0]

    def load_tiny():
        snaps = read_snapshots(spark, tiny_dir, schema=SNAPSHOT_FOR_RECORDS)
        sinks.overwrite_records(repair.backfill(snaps, START, NOW), os.path.join(work, "tiny"))
    timed("ingest_one_document_files", load_tiny)

    fact = sinks.read_records(spark, fact_dir)
    queries = {
        "transactions_by_hour": lambda: transactions.transactions_by_hour(fact, TZ),
        "station_day_timeline": lambda: dashboard.station_day_timelines(fact, TZ),
        "minute_fill_station": lambda: dashboard.station_timeline(fact, span=None, tz=TZ,
                                                                   pad=None),
        "network_timeline": lambda: dashboard.network_timeline(fact, span=None, tz=TZ,
                                                               band=(10, 400), pad=None),
        "hourly_profile": lambda: network.hourly_profile(fact, START, NOW),
        "network_kpis": lambda: network.network_kpis(network.latest_readings(fact)),
        "empty_station_events": lambda: network.empty_station_events(fact, stations, START, NOW),
        "repair_window": lambda: repair.repair_window(fact, "2024-01-20 22:35:00 UTC",
                                                      "2024-01-21 13:40:00 UTC"),
        "animation_frames": lambda: frames.frame_entries(
            frames.frame_points(fact, stations, tz=TZ)),
        "unnest_snapshot": lambda: flatten_snapshots(read_snapshots(spark, raw_dir)),
        # Interactive views: one chart each, partition-pruned on the stored table.
        "view_transactions_today": lambda: transactions.transactions_by_hour(fact, TZ, DAY),
        "view_station_7d": lambda: dashboard.station_timeline(
            fact, station=7, span="7d", now=dt.datetime(2024, 1, 20, 12), tz=TZ),
        "view_network_today": lambda: dashboard.network_timeline(
            fact, span="today", now=dt.datetime(2024, 1, 20, 12), tz=TZ, band=(10, 400)),
        "view_profile_station": lambda: network.hourly_profile(fact, START, NOW, station=7,
                                                               weekday="Monday"),
    }
    for name, build in queries.items():
        timed(name, lambda b=build: _run(b()))

    ingest = timings["ingest_json_to_parquet"]
    out = {
        "metric": "total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "ingest_docs_per_sec": round(load_report.docs / ingest, 1),
        "ingest_rows_per_sec": round(load_report.rows / ingest, 1),
        "one_document_files": files,
        "files_per_sec": round(files / timings["ingest_one_document_files"], 1),
        "file_rows_per_sec": round(dense_report.rows / timings["ingest_one_document_files"], 1),
        "dense_docs": dense_report.docs,
        "dense_rows": dense_report.rows,
        "dense_docs_per_sec": round(dense_report.docs / timings["ingest_dense_day"], 1),
        "dense_rows_per_sec": round(dense_report.rows / timings["ingest_dense_day"], 1),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
