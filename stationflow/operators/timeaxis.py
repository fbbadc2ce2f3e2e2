"""Minute axis operators: first value per minute, gap filling and tail padding.

All of them are keyed (``keys`` may be empty for a network-wide series) and run
as aggregations, neighbour lookups by day and ``explode(sequence(...))``; no
grid join and nothing collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.operators.sequential import with_next_minute
from stationflow.schemas import MINUTES_PER_DAY

MICROS_PER_MINUTE = 60_000_000


def _local_label(utc_micros, tz: str) -> Column:
    """Wall clock of ``utc_micros`` in ``tz``, by the zone rules of that very instant."""
    return F.from_utc_timestamp(F.timestamp_micros(utc_micros), tz).cast("timestamp_ntz")


def minute_first(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str],
                 tiebreak: Sequence[str] = (), minute: str = "minute") -> DataFrame:
    """One row per (keys, minute): for each value column, its first non-null
    value in ``ts`` order within the minute (null when all are null). Rows without
    ``ts`` belong to no minute.

    A plain aggregation, so Spark combines map-side before the shuffle and a hot
    key costs no more than its number of distinct minutes.
    """
    # A plain long ordering keeps the aggregation hash-based; a struct (with
    # tie-breakers) makes it sort-based.
    order = (F.unix_micros(F.col(ts)) if not tiebreak
             else F.struct(F.col(ts), *[F.col(c) for c in tiebreak]))
    aggs = [F.min_by(F.col(v), F.when(F.col(v).isNotNull(), order)).alias(v) for v in values]
    return (df.where(F.col(ts).isNotNull())
            .groupBy(*keys, F.date_trunc("minute", F.col(ts)).alias(minute)).agg(*aggs))


def minute_fill(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                minute: str = "minute", label: str | None = None, tz: str | None = None,
                pad: int | None = None) -> DataFrame:
    """Dense 1-minute series per key from its first to its last minute.

    ``df`` holds at most one row per (keys, minute) — see ``minute_first``. Each
    observed row is repeated up to the minute before the next observed one, so a
    missing minute carries the last observed row, including an observed null. With
    ``pad``, null-valued minutes follow the last one until the key has that many rows
    (as ``pad_tail`` would add them, in the same pass). With ``label``, a wall-clock
    column in ``tz`` is added.
    """
    keys, values = list(keys), list(values)
    d = with_next_minute(df, keys, values, minute, first="__from")
    # Generate minute offsets as longs and rebuild timestamps with integer
    # arithmetic: about twice as fast as a timestamp sequence with an interval step.
    start, after, begin = (F.unix_micros(F.col(c)) for c in (minute, "__next", "__from"))
    gap = F.floor((after - start) / MICROS_PER_MINUTE) - 1
    missing = (F.lit(pad - 1) - F.floor((start - begin) / MICROS_PER_MINUTE)) if pad else F.lit(0)
    steps = F.greatest(F.coalesce(gap, missing), F.lit(0)).cast("bigint")
    # Per-observation columns are computed in their own projection below the
    # generator; in the generator's select they would be evaluated per output row.
    # The generator counts in microseconds, so that an instant needs no arithmetic.
    s = d.select(*keys, start.alias("__start"), (start + steps * MICROS_PER_MINUTE).alias("__stop"),
                 F.col("__next").isNull().alias("__last"), *values)
    each = F.sequence(F.col("__start"), F.col("__stop"), F.lit(MICROS_PER_MINUTE).cast("bigint"))
    g = s.select(*keys, "__start", "__last", F.explode(each).alias("__at"), *values)
    lab = [_local_label(F.col("__at"), tz).alias(label)] if label else []
    # Without padding the last observation is one row, its own.
    padded = F.col("__last") & (F.col("__at") > F.col("__start"))
    return g.select(*keys, F.timestamp_micros("__at").alias(minute), *lab,
                    *[F.when(~padded, F.col(v)).alias(v) if pad else F.col(v) for v in values])


def series_span(df: DataFrame, keys: Sequence[str], minute: str = "minute") -> DataFrame:
    """Per key: rows a gap-free minute series from the first to the last minute of
    ``df`` has (``__n``) and its last minute (``__last``); read from the sparse
    series, so the dense one is never scanned for it."""
    g = df.groupBy(*keys).agg(F.min(minute).alias("__first"), F.max(minute).alias("__last"))
    n = (F.unix_seconds(F.col("__last")) - F.unix_seconds(F.col("__first"))) / 60 + 1
    return g.select(*keys, n.cast("bigint").alias("__n"), "__last")


def pad_tail(df: DataFrame, keys: Sequence[str], values: Sequence[str],
             length: int = MINUTES_PER_DAY, minute: str = "minute",
             span: DataFrame | None = None, label: str | None = None,
             tz: str | None = None) -> DataFrame:
    """Append null-valued minutes after each key's last minute until the key has
    ``length`` rows; keys that already have ``length`` rows or more are unchanged.

    ``span`` (keys, ``__n``, ``__last``) may be given when the row count is known
    without scanning ``df`` (see ``series_span``); otherwise it is counted.
    """
    keys, values = list(keys), list(values)
    if span is None:
        span = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                                     F.max(minute).alias("__last"))
    types = dict(df.dtypes)
    last = F.unix_micros(F.col("__last"))
    count = (F.lit(length) - F.col("__n")).cast("bigint")
    # An empty series without keys has one span row without a last minute.
    s = span.where((F.col("__n") < length) & F.col("__last").isNotNull()).select(
        *keys, last.alias("__start"), count.alias("__count"))
    pads = s.select(*keys, "__start", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__count"))).alias("__i"))
    at = F.col("__start") + F.col("__i") * MICROS_PER_MINUTE
    lab = [_local_label(at, tz).alias(label)] if label else []
    pads = pads.select(*keys, F.timestamp_micros(at).alias(minute), *lab,
                       *[F.lit(None).cast(types[v]).alias(v) for v in values])
    return df.select(*keys, minute, *([label] if label else []), *values).unionByName(pads)


def hour_axis(days: DataFrame, day_cols: Sequence[str], hour: str = "hour_of_day") -> DataFrame:
    """Every (day, hour 0..23) for the distinct days given."""
    return (days.select(*day_cols).distinct()
            .select(*day_cols, F.explode(F.sequence(F.lit(0), F.lit(23))).alias(hour)))
