"""Raw snapshot files: scan, file accounting, capture time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.functions.codec import capture_time_from_name, file_basename
from stationflow.schemas import SNAPSHOT

CORRUPT = "_corrupt_record"


def read_snapshots(spark: SparkSession, paths: str | Sequence[str],
                   schema: T.StructType = SNAPSHOT, keep_corrupt: bool = False,
                   recursive: bool = False) -> DataFrame:
    """Scan snapshot JSON (one document per line) with a declared schema.

    ``paths`` may be files, folders or globs; Spark splits and packs the files
    into tasks itself, so there is no batching by hand. With ``keep_corrupt``
    the raw text of unparsable lines is kept in ``_corrupt_record`` (the other
    fields are then null) so that rejects can be counted instead of vanishing.
    """
    reader = spark.read.schema(schema)
    if keep_corrupt:
        reader = (spark.read.schema(T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())]))
                  .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.json(list(paths) if not isinstance(paths, str) else paths)


def with_source_file(snapshots: DataFrame, tz: str = "Europe/Paris") -> DataFrame:
    """Add the source file name and the capture instant it encodes."""
    name = file_basename(F.col("_metadata.file_path"))
    return snapshots.select("*", name.alias("source_file"),
                            capture_time_from_name(name, tz).alias("captured_at"))


def file_report(snapshots: DataFrame) -> DataFrame:
    """Source files of a scan and the documents they hold; see ``flatten.load_report`` for
    what of them a load can use."""
    return snapshots.agg(F.count_distinct(F.col("_metadata.file_path")).alias("files"),
                         F.count(F.lit(1)).alias("documents"))
