"""The station dimension with its history (type 2).

A station is renamed, moved or given another type now and then, while every snapshot repeats
its description. Kept is what each station was called on each local day: the last description
of the day. Taking the last one is the same in any order and however often, so a load appends
the days that it has seen, and neither late nor repeated loads nor two loads at once can spoil
the table. Ranges of validity are made from it: one row for each change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.functions.timefn import DEFAULT_TZ, local_date
from stationflow.schemas import RECORD_DATE, STATION_COLUMNS, STATIONS
from stationflow.sources import dated

ATTRIBUTES = [c for c in STATION_COLUMNS if c != "id"]
SEEN = ["record_timestamp", "last_update"]
DAILY = T.StructType([*STATIONS.fields, *[T.StructField(c, T.TimestampType()) for c in SEEN]])


def _last(rows: DataFrame) -> DataFrame:
    """The last description by station and day; among equal times the greatest, so it's always the same."""
    best = F.max(F.struct(*SEEN, *ATTRIBUTES)).alias("x")
    return (rows.groupBy("id", RECORD_DATE).agg(best)
            .select("id", *[f"x.{c}" for c in [*ATTRIBUTES, *SEEN]], RECORD_DATE))


def daily_descriptions(rows: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Last description of every station and local day (``record_date``) of realtime rows
    (``flatten.flatten_realtime``). Rows without an id or a time are left out."""
    known = rows.where(F.col("id").isNotNull() & F.col("record_timestamp").isNotNull())
    return _last(known.withColumn(RECORD_DATE, local_date("record_timestamp", tz)))


def append_descriptions(rows: DataFrame, path: str, tz: str = DEFAULT_TZ, name: str | None = None) -> None:
    """Add what a load has seen to the kept days; a load may come late, twice or along with others."""
    dated.append(daily_descriptions(rows, tz), path, name)


def kept_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """One row a station and day of all loads."""
    return _last(dated.read(spark, path, DAILY))


def description_ranges(daily: DataFrame) -> DataFrame:
    """The station columns with ``valid_from`` and ``valid_to`` (exclusive, null while it holds): a
    row for the first description of a station and one for every change. Days without a
    reading keep the description before. A window holds one narrow row a day of a station."""
    along = Window.partitionBy("id").orderBy(RECORD_DATE)
    described = F.struct(*ATTRIBUTES)
    changes = daily.withColumn("__new", ~described.eqNullSafe(F.lag(described).over(along))).where("__new")
    return changes.select(*STATION_COLUMNS, F.col(RECORD_DATE).alias("valid_from"),
                          F.lead(RECORD_DATE).over(along).alias("valid_to"))


def current(ranges: DataFrame) -> DataFrame:
    """The latest slice: the dimension as of now."""
    return ranges.where(F.col("valid_to").isNull()).select(*STATION_COLUMNS)


def join_as_of(records: DataFrame, ranges: DataFrame, columns=ATTRIBUTES, tz: str = DEFAULT_TZ) -> DataFrame:
    """``records`` with the ``columns`` of their station on the local day of the reading; null before
    its first description. Readings keep their number."""
    r = records.withColumn("__day", local_date("record_timestamp", tz)).alias("r")
    s = ranges.alias("s")
    day = F.col("r.__day")
    on = ((F.col("r.station_id") == F.col("s.id")) & (day >= F.col("s.valid_from"))
          & (F.col("s.valid_to").isNull() | (day < F.col("s.valid_to"))))
    return r.join(s, on, "left").select(*[F.col(f"r.{c}") for c in records.columns], *[F.col(f"s.{c}") for c in columns])
