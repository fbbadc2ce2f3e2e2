"""Writers: raw archive, bronze, the partitioned fact table and frame datasets.

Column order is fixed by ``select`` before every write, so positional inserts
cannot shift columns. Records are partitioned by ``record_date`` (UTC date of
``record_timestamp``). The fact table that loads, stream and repair share is a dated table
(``sources.dated``); a plain folder is appended to or overwritten by date here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.timefn import local_time
from stationflow.schemas import RECORD_COLUMNS, RECORD_DATE
from stationflow.sources import dated

# JSON text keeps microseconds (Spark's default writer format stops at millis).
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_snapshots_json(snapshots: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw documents as JSON lines, full timestamp precision."""
    snapshots.write.mode(mode).option("timestampFormat", JSON_TIMESTAMP_FORMAT).json(path)


def with_record_date(records: DataFrame) -> DataFrame:
    return records.select(*RECORD_COLUMNS,
                          F.to_date(F.col("record_timestamp")).alias(RECORD_DATE))


def balanced_by_date(records: DataFrame) -> DataFrame:
    """Rows with ``record_date``, rebalanced on it before a partitioned write.

    Without a shuffle every task writes one file into every date it holds (tasks
    × dates small files). ``REBALANCE`` sends each date to few tasks; adaptive
    execution then coalesces small dates and splits large ones to the advisory
    partition size, so files come out near that size whatever the data volume.
    """
    return with_record_date(records).hint("rebalance", RECORD_DATE)


def append_records(records: DataFrame, path: str, mode: str = "append") -> None:
    """Append to the fact table, or to a plain folder where there is none (no key: re-appending
    duplicates rows)."""
    if dated.exists(records.sparkSession, path):
        return dated.append(with_record_date(records), path)
    (balanced_by_date(records).write.mode(mode)
     .option("partitionOverwriteMode", "static").partitionBy(RECORD_DATE).parquet(path))


def overwrite_records(records: DataFrame, path: str, dynamic: bool = True) -> None:
    """Overwrite a plain folder of records; with ``dynamic`` only the dates present in
    ``records`` are replaced."""
    (balanced_by_date(records).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy(RECORD_DATE).parquet(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The stored fact table, a dated table or a plain folder; filters on ``record_date`` prune
    partitions."""
    return dated.read(spark, path) if dated.exists(spark, path) else spark.read.parquet(path)


def write_bronze(snapshots: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nested snapshots kept as they are (Parquet keeps the nesting)."""
    snapshots.write.mode(mode).parquet(path)


def archive_raw(snapshots: DataFrame, path: str, captured_at: str = "captured_at",
                tz: str = "Europe/Paris", mode: str = "append") -> None:
    """Raw documents as JSON lines, partitioned by local capture date.

    Spark names the part files itself, so no ':' ever reaches a path.
    """
    day = F.date_format(local_time(F.col(captured_at), tz), "yyyy_MM_dd").alias("capture_date")
    docs = snapshots.select("*", day).hint("rebalance", "capture_date")
    (docs.write.mode(mode).option("timestampFormat", JSON_TIMESTAMP_FORMAT)
     .partitionBy("capture_date").json(path))


def write_frames_json(frames: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Animation frames keyed by minute, one JSON object per line."""
    frames.write.mode(mode).json(path)


def write_timemap_csv(frames: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV folder per ``time_index`` (``time_index=HHmm/part-*.csv``)."""
    (frames.select("time_index", "record_timestamp", "latitude", "longitude",
                   "nb_velos_dispo", "ratio").hint("rebalance", "time_index")
     .write.mode(mode).option("header", True).partitionBy("time_index").csv(path))


def read_timemap_csv(spark: SparkSession, path: str) -> DataFrame:
    """All frames written by ``write_timemap_csv``; ``time_index`` stays text (``0030``)."""
    schema = ("record_timestamp timestamp, latitude double, longitude double, nb_velos_dispo int, "
              "ratio double, time_index string")
    return spark.read.schema(schema).option("header", True).csv(path)
