"""Time-range filters that reach the scan.

Bounds are literals on the raw UTC column, so Parquet filter pushdown applies.
On the stored fact table (which has the ``record_date`` partition column, the
UTC date of ``record_timestamp``) the matching date bounds are added as well:
Spark does not derive partition predicates from a timestamp range by itself, so
without them a one-day query would still list and open every date folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions.timefn import to_utc_datetime, ts_literal
from stationflow.schemas import RECORD_DATE


def _date_bounds(df: DataFrame, start, end, keep_null: bool = False) -> Column | None:
    if RECORD_DATE not in df.columns or (start is None and end is None):
        return None
    d = F.col(RECORD_DATE)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (d >= F.lit(to_utc_datetime(start).date()))
    if end is not None:
        cond = cond & (d <= F.lit(to_utc_datetime(end).date()))
    return (d.isNull() | cond) if keep_null else cond


def time_range(df: DataFrame, start=None, end=None, ts: str = "record_timestamp",
               closed: bool = False) -> DataFrame:
    """Rows with ``start <= ts < end`` (``<= end`` when ``closed``); either bound
    may be None."""
    c = F.col(ts)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= ts_literal(start))
    if end is not None:
        cond = cond & ((c <= ts_literal(end)) if closed else (c < ts_literal(end)))
    dates = _date_bounds(df, start, end) if ts == "record_timestamp" else None
    return df.where(cond if dates is None else cond & dates)


def outside_removed(df: DataFrame, start, end, ts: str = "record_timestamp") -> DataFrame:
    """``DELETE WHERE ts < start OR ts >= end``: rows whose predicate is not true
    survive, so rows with a null timestamp are kept (and so is the null-date
    partition)."""
    c = F.col(ts)
    outside = (c < ts_literal(start)) | (c >= ts_literal(end))
    cond = ~F.coalesce(outside, F.lit(False))
    dates = _date_bounds(df, start, end, keep_null=True) if ts == "record_timestamp" else None
    return df.where(cond if dates is None else cond & dates)
