"""Borrow and return counts kept up by a stream of snapshots.

The state of the stream is one station's readings of one local day, at most one a minute. It
comes from a streaming aggregation, so Spark keeps it in its state store, adds what a batch
brings and drops a day when the watermark has passed it. A day's changes are taken anew
from its sorted readings whenever one is added, so files may come in any order within
``lateness``: a reading between two others splits their change.

The counts are a dated table of station, local day and hour. A batch replaces the rows of the
stations and days that it has touched, so a replayed batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationflow.functions.timefn import DEFAULT_TZ, local_time
from stationflow.operators.flatten import flatten_snapshots
from stationflow.schemas import RECORD_DATE, SNAPSHOT_FOR_RECORDS
from stationflow.sources import dated
from stationflow.sources.snapshots import CORRUPT
from stationflow.streaming.ingest import snapshot_stream, started

#: ``record_date`` is the local date.
HOURS = T.StructType([T.StructField("station_id", T.LongType()), T.StructField("hour_of_day", T.IntegerType()),
                      T.StructField("borrowed", T.LongType()), T.StructField("returned", T.LongType())])


def station_days(readings: DataFrame, tz: str = DEFAULT_TZ, lateness: str | None = None) -> DataFrame:
    """Readings gathered by station and local day. ``day_start``, the instant of local midnight,
    carries the watermark of a stream: a day is dropped when one has begun that starts more
    than ``lateness`` after it."""
    local = local_time("record_timestamp", tz)
    rows = (readings.where(F.col("station_id").isNotNull() & F.col("record_timestamp").isNotNull())
            .select("station_id", F.to_date(local).alias("local_date"),
                    F.to_utc_timestamp(F.to_date(local).cast("timestamp"), tz).alias("day_start"),
                    F.struct("record_timestamp", "last_update", "nb_available_bikes",
                             F.hour(local).alias("hour_of_day")).alias("reading")))
    if lateness:
        rows = rows.withWatermark("day_start", lateness)
    return rows.groupBy("station_id", "local_date", "day_start").agg(F.collect_list("reading").alias("readings"))


def hours_of(days: DataFrame) -> DataFrame:
    """Hours of gathered days in which bikes were borrowed or returned (as in
    ``transactions.transactions_by_hour``, but by station)."""
    ordered = days.select("station_id", "local_date", F.array_sort("readings").alias("r"))
    before = F.transform("r", lambda x, i: F.struct(
        x["hour_of_day"].alias("hour_of_day"),
        (F.get("r", i - 1)["nb_available_bikes"] - x["nb_available_bikes"]).alias("v")))
    v = F.col("d.v")
    return (ordered.select("station_id", "local_date", F.explode(before).alias("d")).where("d.v <> 0")
            .groupBy("station_id", "local_date", F.col("d.hour_of_day").alias("hour_of_day"))
            .agg(F.sum(F.when(v > 0, v).otherwise(0)).alias("borrowed"),
                 F.sum(F.when(v < 0, -v).otherwise(0)).alias("returned")))


def transactions_stream(spark: SparkSession, source_dir: str, table_path: str, checkpoint: str,
                        tz: str = DEFAULT_TZ, lateness: str = "2 days", trigger: str | None = "1 minute",
                        available_now: bool = False, strict: bool = True,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream. Cut-off lines and records without a station or time count nothing (the
    ingest keeps them as rejects); with ``strict`` a station id that is no number fails the
    batch. Readings of a day that the watermark has passed are not counted any more."""
    docs = snapshot_stream(spark, source_dir, max_files_per_trigger, SNAPSHOT_FOR_RECORDS)
    days = station_days(flatten_snapshots(docs.where(F.col(CORRUPT).isNull()), strict), tz, lateness)

    def write(batch: DataFrame, batch_id: int) -> None:
        changed = batch.persist()
        try:
            touched = changed.select("station_id", F.col("local_date").alias(RECORD_DATE)).distinct()
            dates = [r[0] for r in touched.select(RECORD_DATE).distinct().collect()]  # the days of a batch
            if not dates:
                return
            fresh = hours_of(changed).withColumnRenamed("local_date", RECORD_DATE)

            def build(stored: DataFrame) -> DataFrame:
                kept = (stored.where(F.col(RECORD_DATE).isin(dates))
                        .join(touched, ["station_id", RECORD_DATE], "left_anti"))
                return kept.unionByName(fresh)

            dated.replace(spark, table_path, dates, build, HOURS)
        finally:
            changed.unpersist()

    return started(days.writeStream.outputMode("update").foreachBatch(write), checkpoint, trigger, available_now)


def kept_transactions(spark: SparkSession, table_path: str) -> DataFrame:
    """Bikes borrowed and returned by local day and hour, from the kept table; hours without
    any are absent."""
    hours = dated.read(spark, table_path, HOURS)
    return (hours.groupBy(F.col(RECORD_DATE).alias("local_date"), "hour_of_day")
            .agg(F.sum("borrowed").alias("borrowed"), F.sum("returned").alias("returned")))
