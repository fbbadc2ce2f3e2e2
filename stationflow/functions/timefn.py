"""Time functions: zone conversion, interval arithmetic, truncation and labels.

Stored timestamps are UTC instants. Local wall-clock values are returned as
``TIMESTAMP_NTZ`` so that they are never reinterpreted by a session zone.
``tz`` is either a region id (``"Europe/Paris"``, DST-correct) or a fixed offset
(``"+02:00"``, the legacy display convention).
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.schemas import WEEKDAY_INDEX

DEFAULT_TZ = "Europe/Paris"


def one_minute() -> Column:
    """A one-minute day-time interval (built lazily: needs an active session)."""
    return F.make_dt_interval(mins=F.lit(1))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def local_time(col, tz: str = DEFAULT_TZ) -> Column:
    """Wall-clock time in ``tz`` of a UTC instant, as TIMESTAMP_NTZ."""
    return F.from_utc_timestamp(_c(col), tz).cast("timestamp_ntz")


def local_date(col, tz: str = DEFAULT_TZ) -> Column:
    """``DATE(ts, tz)``: calendar date in ``tz``."""
    return F.to_date(local_time(col, tz))


def local_hour(col, tz: str = DEFAULT_TZ) -> Column:
    return F.hour(local_time(col, tz))


def minute_of(col) -> Column:
    """Truncate to the minute (``%Y-%m-%d %H:%M`` then re-parse)."""
    return F.date_trunc("minute", _c(col))


def minute_label(col) -> Column:
    return F.date_format(_c(col), "yyyy-MM-dd HH:mm")


def hhmm_label(col) -> Column:
    """Time-of-day frame key ``HHmm``."""
    return F.date_format(_c(col), "HHmm")


def hhmm_display(label) -> Column:
    """``HHmm`` → ``HH:MM``."""
    c = _c(label)
    return F.concat_ws(":", F.substring(c, 1, 2), F.substring(c, 3, 2))


def weekday_index(name: str) -> int:
    """Weekday name → DAYOFWEEK index (Sunday = 1). Unknown names raise."""
    try:
        return WEEKDAY_INDEX[name]
    except KeyError:
        raise ValueError(f"unknown weekday {name!r}") from None


def axis_label(local_minute, span: str) -> Column:
    """Tick label of a minute axis: ``HHh`` every 3 hours for 'today'/'24h',
    ``dd/MM`` at midnight for '7d'; null elsewhere."""
    c = _c(local_minute)
    on_hour = F.minute(c) == 0
    if span in ("today", "24h"):
        return F.when(on_hour & (F.hour(c) % 3 == 0), F.concat(F.date_format(c, "HH"), F.lit("h")))
    if span == "7d":
        return F.when(on_hour & (F.hour(c) == 0), F.date_format(c, "dd/MM"))
    raise ValueError(f"unknown span {span!r}")


def hour_axis_label(hour) -> Column:
    """Bar-chart hour label: ``<h>h`` on 0, 3, …, 21."""
    c = _c(hour)
    return F.when(c % 3 == 0, F.concat(c.cast("string"), F.lit("h")))


# ---------------------------------------------------------------------------
# Driver-side bound arithmetic. Bounds become literals so that the filters on the
# raw UTC column push down to the Parquet scan and prune date partitions.

def _zone(tz: str) -> dt.tzinfo:
    if tz and tz[0] in "+-" and ":" in tz:
        sign = 1 if tz[0] == "+" else -1
        hh, mm = tz[1:].split(":")
        return dt.timezone(sign * dt.timedelta(hours=int(hh), minutes=int(mm)))
    return ZoneInfo(tz)


def _as_utc(value: dt.datetime) -> dt.datetime:
    if value.tzinfo is None:
        return value.replace(tzinfo=dt.timezone.utc)
    return value.astimezone(dt.timezone.utc)


def local_midnight_utc(day: dt.date, tz: str = DEFAULT_TZ) -> dt.datetime:
    """UTC instant of local midnight starting ``day`` (naive UTC datetime)."""
    local = dt.datetime.combine(day, dt.time(0), tzinfo=_zone(tz))
    return local.astimezone(dt.timezone.utc).replace(tzinfo=None)


def local_day_bounds(day: dt.date, tz: str = DEFAULT_TZ) -> tuple[dt.datetime, dt.datetime]:
    """Half-open UTC range ``[start, end)`` covering local calendar ``day``.

    Both ends are converted separately, so 23- and 25-hour days are right.
    """
    return local_midnight_utc(day, tz), local_midnight_utc(day + dt.timedelta(days=1), tz)


def span_bounds(span: str, now: dt.datetime, tz: str = DEFAULT_TZ) -> dt.datetime:
    """Lower UTC bound of a dashboard span; there is no upper bound.

    ``today`` → local midnight of today; ``24h`` → now − 24 h;
    ``7d`` → local midnight seven days ago. ``now`` is a UTC instant (naive = UTC).
    """
    now_utc = _as_utc(now)
    local_now = now_utc.astimezone(_zone(tz))
    if span == "today":
        return local_midnight_utc(local_now.date(), tz)
    if span == "24h":
        return (now_utc - dt.timedelta(hours=24)).replace(tzinfo=None)
    if span == "7d":
        return local_midnight_utc(local_now.date() - dt.timedelta(days=7), tz)
    raise ValueError(f"unknown span {span!r}; expected 'today', '24h' or '7d'")


def local_today(now: dt.datetime, tz: str = DEFAULT_TZ) -> dt.date:
    return _as_utc(now).astimezone(_zone(tz)).date()


def to_utc_datetime(value: dt.datetime | dt.date | str) -> dt.datetime:
    """Naive UTC datetime from a datetime (naive = UTC), a date, or ISO text
    (``'2023-11-22 22:35:00 UTC'``, ``'...Z'``, ``'...+02:00'``)."""
    if isinstance(value, str):
        text = value.strip()
        if text.endswith(" UTC"):
            text = text[:-4] + "+00:00"
        if text.endswith("Z"):
            text = text[:-1] + "+00:00"
        value = dt.datetime.fromisoformat(text)
    elif isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time(0))
    return _as_utc(value).replace(tzinfo=None)


def ts_literal(value: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP literal of a UTC instant.

    Built from zone-qualified text, so neither the session zone nor the Python
    process zone can shift it; constant folding makes it a plain literal that
    Parquet filter pushdown accepts.
    """
    utc = to_utc_datetime(value)
    return F.lit(utc.strftime("%Y-%m-%dT%H:%M:%S.%fZ")).cast("timestamp")
