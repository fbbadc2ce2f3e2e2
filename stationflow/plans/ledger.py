"""Loads by file, with a ledger of what was loaded.

A load takes the files of a folder that no earlier load has taken, in batches of a bounded
number of bytes and files. Each batch is written down before it begins (``plan``) and after
it has ended (``loaded``, with what each file held). A load that failed between the two is
finished by the next one: rows that it had added already aren't added again, as the files
of a batch move into the fact table under the batch's name.

Files that have another length or time than when they were loaded are reported and not
loaded again; replace their window instead (``maintenance.load_window``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.operators.flatten import flatten_snapshots, report_columns
from stationflow.plans.maintenance import keep_rejects
from stationflow.schemas import SNAPSHOT_FOR_RECORDS
from stationflow.session import path_exists
from stationflow.sources import dated
from stationflow.sources.sinks import with_record_date
from stationflow.sources.snapshots import CORRUPT, read_snapshots

PLAN = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
                     T.StructField("modified", T.TimestampType())])
COUNTS = ("documents", "corrupt", "empty", "station_rows", "bad_ids", "loaded_rows")
LOADED = T.StructType([*PLAN.fields, *[T.StructField(c, T.LongType()) for c in COUNTS],
                       T.StructField("batch", T.LongType())])
MAX_BYTES, MAX_FILES = 64 << 30, 50_000


def source_files(spark: SparkSession, raw_dir: str, pattern: str = "*.json") -> DataFrame:
    """(path, length, modified) of the files of a folder and its subfolders; none is opened."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
              .option("recursiveFileLookup", "true").load(raw_dir))
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished entries of ``plan`` or ``loaded``."""
    if not path_exists(spark, path):
        return []
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = [f.getPath().getName() for f in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    return sorted(int(n.partition("=")[2]) for n in found
                  if n.startswith("batch=") and path_exists(spark, f"{path}/{n}/_SUCCESS"))


def loaded_files(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger: every loaded file with what it held (``flatten.load_report``) and its batch."""
    done = _batches(spark, f"{ledger}/loaded")
    if not done:
        return spark.createDataFrame([], LOADED)
    return (spark.read.schema(LOADED).option("basePath", f"{ledger}/loaded")
            .parquet(*[f"{ledger}/loaded/batch={b}" for b in done]))


def new_files(spark: SparkSession, raw_dir: str, ledger: str) -> DataFrame:
    return source_files(spark, raw_dir).join(loaded_files(spark, ledger).select("path"), "path", "left_anti")


def changed_files(spark: SparkSession, raw_dir: str, ledger: str) -> DataFrame:
    """Loaded files that now have another length or time: ``path``, ``length``, ``modified``,
    ``loaded_length``, ``loaded_modified``, ``batch``."""
    then = loaded_files(spark, ledger).select("path", F.col("length").alias("loaded_length"),
                                              F.col("modified").alias("loaded_modified"), "batch")
    return (source_files(spark, raw_dir).join(then, "path")
            .where((F.col("length") != F.col("loaded_length")) | (F.col("modified") != F.col("loaded_modified"))))


def _cut(files: DataFrame, max_bytes: int, max_files: int) -> Iterator[list]:
    """The files in order of their paths, which tell the capture time, a batch at a time."""
    batch, size = [], 0
    for f in files.select(*PLAN.names).orderBy("path").toLocalIterator(prefetchPartitions=False):
        if batch and (size + f.length > max_bytes or len(batch) == max_files):
            yield batch
            batch, size = [], 0
        batch.append(f)
        size += f.length
    if batch:
        yield batch


def load_new(spark: SparkSession, raw_dir: str, fact_path: str, ledger: str, strict: bool = True,
             quarantine_path: str | None = None, max_bytes: int = MAX_BYTES, max_files: int = MAX_FILES) -> list[int]:
    """Finish what an earlier load left, then load all new files; returns the batches.

    Rejects as in ``maintenance.load_window``; they go to a folder for each batch. One load
    at a time: a batch has the number after the last one."""
    ran = []
    planned = _batches(spark, f"{ledger}/plan")
    for batch in sorted(set(planned) - set(_batches(spark, f"{ledger}/loaded"))):
        _run(spark, batch, fact_path, ledger, strict, quarantine_path)
        ran.append(batch)
    batch = max(planned, default=-1)
    for files in _cut(new_files(spark, raw_dir, ledger), max_bytes, max_files):
        batch += 1
        spark.createDataFrame(files, PLAN).coalesce(1).write.mode("overwrite").parquet(f"{ledger}/plan/batch={batch}")
        _run(spark, batch, fact_path, ledger, strict, quarantine_path)
        ran.append(batch)
    return ran


def _name(spark: SparkSession, ledger: str) -> str:
    """A name of the ledger's own, so that two ledgers may load into one table."""
    path = f"{ledger}/name"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([(uuid.uuid4().hex[:8],)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).first()[0]


def _run(spark: SparkSession, batch: int, fact_path: str, ledger: str, strict: bool, quarantine_path: str | None) -> None:
    plan = spark.read.schema(PLAN).parquet(f"{ledger}/plan/batch={batch}")
    paths = [r.path for r in plan.select("path").toLocalIterator()]  # MAX_FILES at most
    docs = read_snapshots(spark, paths, schema=SNAPSHOT_FOR_RECORDS, keep_corrupt=True)
    keep_rejects(docs, strict, quarantine_path and f"{quarantine_path}/batch={batch}", f"batch {batch}")
    rows = flatten_snapshots(docs.where(F.col(CORRUPT).isNull()), strict).where(F.col("station_id").isNotNull())
    dated.append(with_record_date(rows), fact_path, f"load-{_name(spark, ledger)}-{batch}", f"{ledger}/staged/{batch}")
    held = (docs.groupBy(F.col("_metadata.file_path").alias("path")).agg(*report_columns(docs)))
    none = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in COUNTS]
    (plan.join(held, "path", "left").select(*PLAN.names, *none)
     .coalesce(1).write.mode("overwrite").parquet(f"{ledger}/loaded/batch={batch}"))
