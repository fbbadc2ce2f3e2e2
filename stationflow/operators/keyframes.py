"""Map frames as hourly key frames and the changes between them.

Neighbouring frames are nearly alike: most stations keep their place and their share of bikes
from one minute to the next. The log keeps a full frame at the start of every hour and, for the
rest of the hour, only the entries that appear, change or go. A minute is rebuilt from the rows
of its own hour, so a reader prunes all other days and hours, and no window holds more than the
sixty minutes of one entry.

What an entry draws is kept: place and share of bikes. The time of the reading isn't, since it
alone would make every entry a change. A station with several readings in a minute has as many
entries, told apart by ``nth`` (in the order of their times).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationflow.functions.timefn import one_minute, to_utc_datetime, ts_literal
from stationflow.operators.sequential import with_next_minute

KEY, CHANGE, GONE = "key", "change", "gone"
VALUES = ["latitude", "longitude", "taux_velos_dispo"]
LOG_SCHEMA = ("frame_hour timestamp, minute timestamp, kind string, station_id bigint, nth int, latitude double, "
              "longitude double, taux_velos_dispo double, frame_date date")


def _hour(col) -> Column:
    return F.date_trunc("hour", col)


def _one_hour() -> Column:
    return F.make_dt_interval(hours=F.lit(1))


def _ticks(points: DataFrame) -> DataFrame:
    """The minutes at which a frame is looked at: those with readings, and the start of every
    hour in between, which repeats the frame of ``observed_minute``. With the ticks before and
    behind in the same hour; behind the last reading of all, the series ends at the next minute."""
    minutes = with_next_minute(points.select("minute").distinct(), [], [], "minute")
    last = F.coalesce(F.col("__next") - one_minute(), F.col("minute"))
    first = _hour(F.col("minute")) + _one_hour()
    starts = F.when(first <= last, F.sequence(first, last, _one_hour()))
    ticks = minutes.select(
        F.col("minute").alias("observed_minute"), F.col("__next").isNull().alias("__ends"),
        F.explode(F.concat(F.array("minute"), F.coalesce(starts, F.array().cast("array<timestamp>")))).alias("minute"))
    ticks = ticks.withColumn("frame_hour", _hour(F.col("minute")))
    along = Window.partitionBy("frame_hour").orderBy("minute")
    end = F.col("minute") + one_minute()
    end = F.when(F.col("__ends") & (_hour(end) == F.col("frame_hour")), end)
    return ticks.select("observed_minute", "minute", "frame_hour", F.lag("minute").over(along).alias("__before"),
                        F.coalesce(F.lead("minute").over(along), end).alias("__behind"))


def key_frames(points: DataFrame) -> DataFrame:
    """The log of ``frames.frame_points``: ``frame_date`` and ``frame_hour`` (UTC), ``minute``,
    ``kind``, ``station_id``, ``nth`` and the values (null for ``gone``).

    ``key`` rows are the full frame at the first minute of an hour, ``change`` rows entries
    that are new or other than at the tick before, ``gone`` rows those that the frame of this
    minute no longer has. No points give no rows."""
    order = Window.partitionBy("minute", "station_id").orderBy("record_timestamp", *VALUES)
    entries = points.select(F.col("minute").alias("observed_minute"), "station_id",
                            F.row_number().over(order).alias("nth"), *VALUES)
    states = entries.join(_ticks(points), "observed_minute")
    along = Window.partitionBy("frame_hour", "station_id", "nth").orderBy("minute")
    states = states.withColumn("__old", F.lag(F.struct("minute", *VALUES)).over(along)) \
                   .withColumn("__new", F.lead("minute").over(along))
    same = F.col("__old.minute") == F.col("__before")
    for v in VALUES:
        same = same & F.col(f"__old.{v}").eqNullSafe(F.col(v))
    kind = F.when(F.col("__before").isNull(), KEY).when(~F.coalesce(same, F.lit(False)), CHANGE)
    goes = F.col("__behind").isNotNull() & ~F.col("__behind").eqNullSafe(F.col("__new"))
    now = F.struct(F.col("minute").alias("minute"), kind.alias("kind"), *VALUES)
    then = F.struct(F.col("__behind").alias("minute"), F.when(goes, GONE).alias("kind"),
                    *[F.lit(None).cast("double").alias(v) for v in VALUES])
    rows = states.select("frame_hour", "station_id", "nth", F.explode(F.filter(
        F.array(now, then), lambda x: x["kind"].isNotNull())).alias("x"))
    return rows.select(F.to_date("frame_hour").alias("frame_date"), "frame_hour", "x.minute", "x.kind",
                       "station_id", "nth", *[f"x.{v}" for v in VALUES])


def rebuild(log: DataFrame, start=None, end=None) -> DataFrame:
    """Frames in long form for the minutes in ``[start, end)`` (all without bounds): ``minute``,
    ``station_id``, ``nth`` and the values, as ``frames.frame_entries`` makes them."""
    near, lo, hi = log, F.lit(None).cast("timestamp"), F.lit(None).cast("timestamp")
    if start is not None:
        lo, day = F.date_trunc("minute", ts_literal(start)), to_utc_datetime(start).date()
        near = near.where((F.col("frame_date") >= F.lit(day)) & (F.col("frame_hour") >= _hour(lo)))
    if end is not None:
        hi, day = ts_literal(end), to_utc_datetime(end).date()
        near = near.where((F.col("frame_date") <= F.lit(day)) & (F.col("frame_hour") < hi))
    along = Window.partitionBy("frame_hour", "station_id", "nth").orderBy("minute")
    until = F.coalesce(F.lead("minute").over(along), F.col("frame_hour") + _one_hour())
    runs = near.withColumn("__until", until).where(F.col("kind") != GONE)
    first, stop = F.greatest("minute", lo), F.least("__until", hi)  # nulls are left out
    runs = runs.select("station_id", "nth", *VALUES, first.alias("__first"), stop.alias("__stop")).where("__first < __stop")
    minutes = F.explode(F.sequence("__first", "__stop", one_minute())).alias("minute")
    return (runs.select(minutes, "station_id", "nth", *VALUES, "__stop").where("minute < __stop").drop("__stop"))


def frame_at(log: DataFrame, minute) -> DataFrame:
    """The entries of one frame: ``station_id``, ``nth`` and the values. None outside of the series."""
    at = F.date_trunc("minute", ts_literal(minute))
    hour = log.where((F.col("frame_date") == F.lit(to_utc_datetime(minute).date()))
                     & (F.col("frame_hour") == _hour(at)) & (F.col("minute") <= at))
    last = hour.groupBy("station_id", "nth").agg(F.max_by(F.struct("kind", *VALUES), "minute").alias("x"))
    return last.where(F.col("x.kind") != GONE).select("station_id", "nth", *[f"x.{v}" for v in VALUES])


def write_key_frames(log: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet by ``frame_date``; within a file rows lie by hour, so that other hours are skipped."""
    (log.hint("rebalance", "frame_date").sortWithinPartitions("frame_date", "frame_hour", "station_id", "minute")
     .write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("frame_date").parquet(path))


def read_key_frames(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)
