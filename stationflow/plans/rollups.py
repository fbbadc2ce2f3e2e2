"""Partial aggregates of the fact table, kept up by increments.

Two dated tables hold what the dashboard adds up: for each UTC date, station, weekday and hour
the sum and count of available bikes (``profile``), and for each snapshot time the bikes and
readings of the network (``network``). Sums and counts of disjoint rows can be added, so a
load adds the partials of its own rows to those of the dates it touches. A replacement or a
repair takes rows away as well: the partials of its dates, and of no other, are made anew
from the fact table.

Reading a chart of any number of dates costs one row for each station, hour and date at most
and no reading of the fact table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.operators.repair import touched_dates
from stationflow.plans import maintenance
from stationflow.schemas import RECORD_DATE
from stationflow.sources import dated
from stationflow.sources.sinks import with_record_date

PROFILE = T.StructType([T.StructField("station_id", T.LongType()), T.StructField("day_of_week", T.IntegerType()),
                        T.StructField("hour_of_day", T.IntegerType()), T.StructField("bikes", T.LongType()),
                        T.StructField("readings", T.LongType())])
NETWORK = T.StructType([T.StructField("record_timestamp", T.TimestampType()), T.StructField("total_bikes", T.LongType()),
                        T.StructField("readings", T.LongType())])


def profile_parts(records: DataFrame) -> DataFrame:
    """Sum and number of the known bike counts by date, station, weekday and hour (UTC)."""
    ts = F.col("record_timestamp")
    return (records.where(ts.isNotNull())
            .groupBy("station_id", F.dayofweek(ts).alias("day_of_week"), F.hour(ts).alias("hour_of_day"),
                     F.to_date(ts).alias(RECORD_DATE))
            .agg(F.sum("nb_available_bikes").alias("bikes"), F.count("nb_available_bikes").alias("readings")))


def network_parts(records: DataFrame) -> DataFrame:
    """Bikes and readings of each snapshot time."""
    ts = F.col("record_timestamp")
    return (records.where(ts.isNotNull()).groupBy(ts, F.to_date(ts).alias(RECORD_DATE))
            .agg(F.sum("nb_available_bikes").alias("total_bikes"), F.count(F.lit(1)).alias("readings")))


_TABLES = {"profile": (PROFILE, profile_parts, ["station_id", "day_of_week", "hour_of_day"]),
           "network": (NETWORK, network_parts, ["record_timestamp"])}


def add(records: DataFrame, path: str) -> None:
    """Add the partials of new rows to the kept ones."""
    spark = records.sparkSession
    dates = [r[0] for r in records.select(F.to_date("record_timestamp").alias("d")).where("d is not null")
             .distinct().collect()]  # the dates of a load
    for name, (schema, parts, keys) in _TABLES.items():
        sums = [f.name for f in schema.fields if f.name not in keys]

        def build(kept: DataFrame) -> DataFrame:
            both = kept.where(F.col(RECORD_DATE).isin(dates)).unionByName(parts(records))
            return both.groupBy(*keys, RECORD_DATE).agg(*[F.sum(c).alias(c) for c in sums])

        if dates:
            dated.replace(spark, f"{path}/{name}", dates, build, schema)


def refresh(spark: SparkSession, fact_path: str, path: str, dates: Iterable[dt.date]) -> None:
    """Make the partials of ``dates`` anew from the fact table, after rows of theirs were
    replaced or taken away."""
    dates = list(dates)
    rows = dated.read(spark, fact_path).where(F.col(RECORD_DATE).isin(dates))
    for name, (schema, parts, _) in _TABLES.items():
        dated.replace(spark, f"{path}/{name}", dates, lambda kept, parts=parts: parts(rows), schema)


def append_kept(records: DataFrame, fact_path: str, path: str) -> None:
    """Append to the fact table and keep the partials up."""
    dated.append(with_record_date(records), fact_path)
    add(records, path)


def replace_kept(spark: SparkSession, records: DataFrame, fact_path: str, path: str, start, end) -> None:
    """``maintenance.replace_window``, with the partials."""
    maintenance.replace_window(spark, records, fact_path, start, end)
    refresh(spark, fact_path, path, touched_dates(start, end))


def repair_kept(spark: SparkSession, fact_path: str, path: str, start, end, **options) -> None:
    """``maintenance.repair_stored``, with the partials."""
    refresh(spark, fact_path, path, maintenance.repair_stored(spark, fact_path, start, end, **options))


def _between(rows: DataFrame, first: dt.date | None, last: dt.date | None) -> DataFrame:
    if first is not None:
        rows = rows.where(F.col(RECORD_DATE) >= F.lit(first))
    return rows if last is None else rows.where(F.col(RECORD_DATE) <= F.lit(last))


def kept_profile(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Mean bikes by station, weekday and hour over whole UTC dates, both included; what
    ``network.hourly_profile`` gives for these days."""
    rows = _between(dated.read(spark, f"{path}/profile", PROFILE), first, last)
    sums = rows.groupBy("station_id", "day_of_week", "hour_of_day").agg(F.sum("bikes").alias("b"),
                                                                        F.sum("readings").alias("n"))
    return sums.select("station_id", "day_of_week", "hour_of_day",
                       F.try_divide("b", "n").alias("avg_nb_available_bikes"))


def kept_totals(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Network total by snapshot time; what ``network.network_total`` gives."""
    return _between(dated.read(spark, f"{path}/network", NETWORK), first, last).drop(RECORD_DATE)
