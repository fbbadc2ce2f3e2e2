"""User-level dashboard operators composed from the operator modules.

Each returns a DataFrame; only a final chart series (one span of one station
or of the network) is small enough to collect, and ``chart_series`` packs it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.timefn import DEFAULT_TZ, local_date, local_today, span_bounds
from stationflow.operators.filters import time_range
from stationflow.operators.flatten import latest_per_key
from stationflow.operators.network import in_band, network_kpis, network_total
from stationflow.operators.timeaxis import minute_fill, minute_first
from stationflow.operators.transactions import loans_total
from stationflow.schemas import MINUTES_PER_DAY, NETWORK_BAND


def minute_timeline(df: DataFrame, keys: Sequence[str], value: str, tz: str = DEFAULT_TZ,
                    pad: int | None = MINUTES_PER_DAY) -> DataFrame:
    """First value per minute → gap-free minute series per key → tail padding.

    Output: ``keys``, ``minute`` (UTC instant), ``local_minute`` (wall clock in
    ``tz``, the chart label) and ``value``.
    """
    keys = list(keys)
    first = minute_first(df, keys, "record_timestamp", [value])
    filled = minute_fill(first, keys, [value], label="local_minute", tz=tz, pad=pad)
    return filled.select(*keys, "minute", "local_minute", value)


def _since(records: DataFrame, span: str | None, now: dt.datetime | None, tz: str) -> DataFrame:
    if span is None:
        return records
    lower = span_bounds(span, now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), tz)
    return time_range(records, lower, None)


def station_timeline(records: DataFrame, station: int | None = None, span: str | None = "today",
                     now: dt.datetime | None = None, tz: str = DEFAULT_TZ,
                     pad: int | None = MINUTES_PER_DAY) -> DataFrame:
    """Available bikes per minute for one station (or every station) since the
    span's lower bound, gap-filled and padded to ``pad`` minutes."""
    r = _since(records, span, now, tz)
    if station is not None:
        r = r.where(F.col("station_id") == F.lit(station))
    r = r.where(F.col("station_id").isNotNull())
    out = minute_timeline(r, ["station_id"], "nb_available_bikes", tz, pad)
    return out.orderBy("minute") if station is not None else out


def station_day_timelines(records: DataFrame, tz: str = DEFAULT_TZ,
                          pad: int | None = MINUTES_PER_DAY, day_format: str | None = None) -> DataFrame:
    """The 'today' timeline of every station for every local day at once. With ``day_format``
    (one that tells all days apart) ``local_date`` is text, made of each reading's day instead
    of the up to 1,500 times as many minutes."""
    day = local_date("record_timestamp", tz)
    r = (records.where(F.col("station_id").isNotNull() & F.col("record_timestamp").isNotNull())
         .withColumn("local_date", F.date_format(day, day_format) if day_format else day))
    return minute_timeline(r, ["station_id", "local_date"], "nb_available_bikes", tz, pad)


def network_series(records: DataFrame, band: tuple[float, float] | None = NETWORK_BAND) -> DataFrame:
    """Network bike total per snapshot, optionally inside the plausibility band."""
    totals = network_total(records)
    return in_band(totals, "total_bikes", *band) if band else totals


def network_timeline(records: DataFrame, span: str | None = "today",
                     now: dt.datetime | None = None, tz: str = DEFAULT_TZ,
                     band: tuple[float, float] | None = NETWORK_BAND,
                     pad: int | None = MINUTES_PER_DAY, daily: bool = False) -> DataFrame:
    """Network total per minute since the span's lower bound (or, with
    ``daily``, one 'today' series per local day)."""
    series = network_series(_since(records, span, now, tz), band)
    keys = []
    if daily:
        series = series.withColumn("local_date", local_date("record_timestamp", tz))
        keys = ["local_date"]
    return minute_timeline(series, keys, "total_bikes", tz, pad)


def index_kpis(records: DataFrame, now: dt.datetime, tz: str = DEFAULT_TZ,
               latest: DataFrame | None = None) -> DataFrame:
    """Headline measures of the latest reading of every station before ``now``,
    plus the loans of the local day of ``now`` up to ``now``.

    ``latest`` is the table of latest readings that the ingest keeps (see
    ``maintenance.merge_latest``); with it, only today's partitions of ``records`` are
    read. Without it the latest readings are taken from all of ``records``."""
    before = time_range(records, None, now)
    if latest is None:
        latest = latest_per_key(before.where(F.col("station_id").isNotNull()), "station_id",
                                ["record_timestamp", "last_update"])
    loans = loans_total(before, tz, local_today(now, tz))
    loan_count = loans.agg(F.coalesce(F.sum("loans"), F.lit(0)).cast("bigint"))
    return network_kpis(latest).select("*", loan_count.scalar().alias("todays_loan_count"))


def chart_series(df: DataFrame, keys: Sequence[str], order: str, label: str,
                 values: Sequence[str]) -> DataFrame:
    """Pack a (small) long series into parallel ``labels``/``values…`` arrays per
    key, in ``order`` (``collect_list`` alone keeps no order)."""
    keys, values = list(keys), list(values)
    items = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(label), *values)))
    g = df.groupBy(*keys).agg(items.alias("__items"))
    def field(name: str):
        return lambda x: x[name]

    out = [F.transform("__items", field(label)).alias("labels")]
    for i, v in enumerate(values):
        name = "values" if i == 0 else f"values{i + 1}"
        out.append(F.transform("__items", field(v)).alias(name))
    return g.select(*keys, *out)
