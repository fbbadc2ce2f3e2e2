"""The gap-free minute series as validity ranges.

A value holds from the minute of its reading up to the minute of the next one. Kept as a range
it is one row and not one for every minute; rows of the dense series are only made for the
window that is asked for. A range is cut at midnight (UTC), so it belongs to one day and the
value at a minute is found by an equi-join on key and day with a range check on what is left:
no task meets more than one key's readings of one day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions.timefn import one_minute, to_utc_datetime, ts_literal
from stationflow.operators.sequential import with_next_minute
from stationflow.operators.timeaxis import minute_first

DAY = "range_date"


def _midnight(day: Column) -> Column:
    return day.cast("timestamp")


def value_ranges(records: DataFrame, keys: Sequence[str], values: Sequence[str], ts: str = "record_timestamp"
                 ) -> DataFrame:
    """``keys``, ``range_date``, ``valid_from``, ``valid_to`` (exclusive) and ``values``: what
    ``minute_fill`` of the first values per minute says, without the minutes. The last
    reading of a key holds for its own minute."""
    keys, values = list(keys), list(values)
    first = minute_first(records, keys, ts, values)
    spans = with_next_minute(first, keys, values).select(
        *keys, *values, F.col("minute").alias("__from"),
        F.coalesce("__next", F.col("minute") + one_minute()).alias("__to"))
    last_day = F.to_date(F.col("__to") - one_minute())
    days = spans.select("*", F.explode(F.sequence(F.to_date("__from"), last_day)).alias(DAY))
    return days.select(
        *keys, DAY, F.greatest("__from", _midnight(F.col(DAY))).alias("valid_from"),
        F.least("__to", _midnight(F.date_add(DAY, 1))).alias("valid_to"), *values)


def value_at(points: DataFrame, ranges: DataFrame, keys: Sequence[str], values: Sequence[str], at: str = "at"
             ) -> DataFrame:
    """``points`` with the ``values`` that hold at the minute of ``at``; null outside of the
    series. Points keep their number."""
    keys = list(keys)
    p = points.withColumn("__day", F.to_date(at)).alias("p")
    r = ranges.alias("r")
    on = [F.col(f"p.{k}") == F.col(f"r.{k}") for k in keys]
    on += [F.col("p.__day") == F.col(f"r.{DAY}"), F.col(f"p.{at}") >= F.col("r.valid_from"),
           F.col(f"p.{at}") < F.col("r.valid_to")]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return p.join(r, condition, "left").select(*[F.col(f"p.{c}") for c in points.columns],
                                               *[F.col(f"r.{v}") for v in values])


def minutes_between(ranges: DataFrame, start, end, keys: Sequence[str], values: Sequence[str],
                    minute: str = "minute") -> DataFrame:
    """Rows of the dense series in ``[start, end)``, made from the ranges of these days only."""
    lo, hi = to_utc_datetime(start), to_utc_datetime(end)
    near = ranges.where(F.col(DAY).between(F.lit(lo.date()), F.lit(hi.date())))
    first = F.greatest("valid_from", F.date_trunc("minute", ts_literal(lo)))
    last = F.least("valid_to", ts_literal(hi))
    cut = near.select(*keys, *values, first.alias("__a"), (last - F.make_dt_interval(
        secs=F.lit(0.000001).cast("decimal(18,6)"))).alias("__z")).where("__a <= __z")
    return (cut.select(*keys, F.explode(F.sequence("__a", "__z", one_minute())).alias(minute), *values)
            .where(F.col(minute) >= ts_literal(lo)))
