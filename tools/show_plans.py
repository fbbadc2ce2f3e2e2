"""Write PLANS.md: the physical-plan facts of the headline operators.

Builds the stored, date-partitioned fact table from the sf0.01 tables in a
scratch folder, runs every operator once (so the adaptive plan is final) and
keeps the lines that matter: scans with their pushed/partition filters and read
schema, exchanges, joins, windows and generators.

    python tools/show_plans.py [sf_dir] [out.md]
"""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import re
import sys
import tempfile
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationflow.operators import frames, network, repair, transactions  # noqa: E402
from stationflow.plans import dashboard, maintenance  # noqa: E402
from stationflow.session import build_session, scratch_path  # noqa: E402
from stationflow.sources import sinks, testdata  # noqa: E402

TZ = "Europe/Paris"
KEEP = re.compile(r"^\(\d+\) (Scan|Exchange|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                  r"BroadcastNestedLoopJoin|CartesianProduct|Window|Generate|HashAggregate|"
                  r"SortAggregate|ObjectHashAggregate)")
DETAIL = re.compile(r"^(PushedFilters|PartitionFilters|ReadSchema|Arguments|Join type|"
                    r"Join condition|Keys|Left keys|Right keys)")


def facts(df) -> list[str]:
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    out, keep = [], False
    for line in text.splitlines():
        if KEEP.match(line):
            keep = True
            out.append(line)
        elif line.startswith("("):
            keep = False
        elif keep and DETAIL.match(line):
            out.append("    " + line[:230])
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    target = argv[2] if len(argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "PLANS.md")
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="stationflow-")})
    spark.sparkContext.setLogLevel("ERROR")
    records, stations = testdata.load_model(spark, sf_dir)
    fact_dir = scratch_path(spark, f"plans-{uuid.uuid4().hex[:8]}")
    sinks.overwrite_records(records, fact_dir)
    fact = sinks.read_records(spark, fact_dir)
    now = dt.datetime(2024, 1, 20, 12)
    latest_dir = scratch_path(spark, f"latest-{uuid.uuid4().hex[:8]}")
    maintenance.merge_latest(spark, fact, latest_dir)
    views = {
        "T4 transactions by hour, one local day (stored table)":
            transactions.transactions_by_hour(fact, TZ, dt.date(2024, 1, 15)),
        "T4 transactions by hour, every day":
            transactions.transactions_by_hour(fact, TZ),
        "T6 station timeline, one station, 7 days":
            dashboard.station_timeline(fact, 7, "7d", now, TZ),
        "T6 'today' timeline of every station and day":
            dashboard.station_day_timelines(fact, TZ),
        "T7 network timeline, today": dashboard.network_timeline(fact, "today", now, TZ, (10, 400)),
        "T8 hourly profile, one station and weekday":
            network.hourly_profile(fact, "2024-01-01 00:00:00 UTC", now, 7, "Monday"),
        "T9 KPIs of the latest reading per station":
            network.network_kpis(network.latest_readings(fact)),
        "T9 index KPIs from the table of latest readings and today's partitions":
            dashboard.index_kpis(fact, now, TZ, maintenance.read_latest(spark, latest_dir)),
        "T10 empty-station events, one day":
            network.empty_station_events(fact, stations, "2024-01-15 00:00:00 UTC",
                                         "2024-01-16 00:00:00 UTC"),
        "T13 repair window": repair.repair_window(fact, "2024-01-20 22:35:00 UTC",
                                                  "2024-01-21 13:40:00 UTC"),
        "T15 animation frames, one hour": frames.frame_entries(frames.frame_points(
            fact, stations, "2024-01-15 08:00:00 UTC", "2024-01-15 09:00:00 UTC", TZ)),
    }
    lines = ["# Physical plans of the headline operators", "",
             f"Generated by `tools/show_plans.py` on `{os.path.basename(sf_dir)}`, fact table stored "
             "as Parquet partitioned by `record_date`; final adaptive plans (operators, scans with "
             "their pushed and partition filters, exchanges, joins, windows, generators).", ""]
    for title, df in views.items():
        lines += [f"## {title}", "", "```"] + facts(df) + ["```", ""]
    with open(target, "w") as fh:
        fh.write("\n".join(lines))
    print("wrote", target)


if __name__ == "__main__":
    main(sys.argv)
