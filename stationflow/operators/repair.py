"""Time-window maintenance of the fact table: load windows and dead-data repair.

Everything here is a pure DataFrame → DataFrame transformation; how the result
replaces stored data (dynamic partition overwrite of the touched dates) is in
``sources.sinks``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.timefn import to_utc_datetime, ts_literal
from stationflow.operators.filters import outside_removed, time_range
from stationflow.operators.flatten import flatten_snapshots
from stationflow.schemas import RECORD_COLUMNS

WEEK = dt.timedelta(days=7)


def keep_window(df: DataFrame, start, end, ts: str = "record_timestamp") -> DataFrame:
    """``DELETE WHERE ts < start OR ts >= end``: rows whose predicate is not true
    survive, so rows with a null timestamp are kept."""
    return outside_removed(df, start, end, ts)


def drop_closed_window(df: DataFrame, start, end, ts: str = "record_timestamp") -> DataFrame:
    """``DELETE WHERE ts >= start AND ts <= end`` (null timestamps survive)."""
    inside = F.col(ts).between(ts_literal(start), ts_literal(end))
    return df.where(~F.coalesce(inside, F.lit(False)))


def select_closed_window(df: DataFrame, start, end, ts: str = "record_timestamp") -> DataFrame:
    return time_range(df, start, end, ts, closed=True)


def repair_window(records: DataFrame, start, end, shift: dt.timedelta = WEEK) -> DataFrame:
    """Replace the closed window ``[start, end]`` by a copy of ``[start − shift,
    end − shift]`` moved forward by ``shift``.

    Only ``record_timestamp`` moves; ``last_update`` keeps the original value.
    The copy is read after the deletion, so when the two windows overlap, the
    overlapping part of the source is already gone (same as delete-then-select).
    """
    lo, hi = to_utc_datetime(start), to_utc_datetime(end)
    kept = drop_closed_window(records, lo, hi)
    source = select_closed_window(kept, lo - shift, hi - shift)
    seconds = int(shift.total_seconds())
    moved = source.withColumn(
        "record_timestamp",
        F.col("record_timestamp") + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)")))
    return kept.select(*RECORD_COLUMNS).unionByName(moved.select(*RECORD_COLUMNS))


def touched_dates(start, end) -> list[dt.date]:
    """UTC dates whose partitions a repair rewrites (the window's dates)."""
    lo, hi = to_utc_datetime(start), to_utc_datetime(end)
    days, d = [], lo.date()
    while d <= hi.date():
        days.append(d)
        d += dt.timedelta(days=1)
    return days


def backfill(snapshots: DataFrame, start, end, strict: bool = True) -> DataFrame:
    """Raw snapshots → records in ``[start, end)`` with a station id.

    Unnest, rename and cast; keep the load window (null timestamps survive, as
    the delete leaves them); drop rows without station id. One lazy plan.
    """
    flat = flatten_snapshots(snapshots, strict)
    return keep_window(flat, start, end).where(F.col("station_id").isNotNull())
