"""Minute ingest as a Structured Streaming job.

New snapshot files in a folder are picked up per micro-batch, flattened by the same
function as the batch load and added to the fact table, a dated table that batch appends,
window loads and repairs use as well, also at the same time.

A micro-batch is written to a folder of its own first; then its files are moved into the
table under names that tell the batch. A replayed batch finds its finished folder and
moves what is left, so a restart neither loses nor repeats rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationflow.operators.flatten import flatten_snapshots
from stationflow.plans.maintenance import keep_rejects
from stationflow.schemas import SNAPSHOT, SNAPSHOT_FOR_RECORDS
from stationflow.sources import dated
from stationflow.sources.sinks import with_record_date
from stationflow.sources.snapshots import CORRUPT


def snapshot_stream(spark: SparkSession, source_dir: str,
                    max_files_per_trigger: int | None = None,
                    schema: T.StructType = SNAPSHOT) -> DataFrame:
    """Snapshot documents of new files; lines that can't be parsed keep their text in
    ``_corrupt_record``."""
    reader = (spark.readStream.schema(T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())]))
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(source_dir)


def started(writer, checkpoint: str, trigger: str | None, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def ingest_stream(spark: SparkSession, source_dir: str, sink_path: str, checkpoint: str,
                  trigger: str | None = "1 minute", available_now: bool = False,
                  strict: bool = True, quarantine_path: str | None = None,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest: every trigger adds the rows of the new files.

    ``strict`` is the policy of the batch load: a station id that is no whole number
    fails the job. With ``strict=False`` such records are left out of the table. What
    can't be loaded (``flatten.rejects``) goes to ``quarantine_path``, one folder for each
    batch, which a replay overwrites. Without that path a corrupt line or (not strict) a
    bad id fails the batch, so that nothing is dropped unseen."""

    def write(batch: DataFrame, batch_id: int) -> None:
        docs = batch.persist()
        try:
            keep_rejects(docs, strict, quarantine_path and f"{quarantine_path}/batch={batch_id}", f"batch {batch_id}")
            good = flatten_snapshots(docs.where(F.col(CORRUPT).isNull()), strict)
            dated.append(with_record_date(good.where(F.col("station_id").isNotNull())), sink_path,
                         f"batch-{batch_id}", f"{checkpoint}/staged/{batch_id}")
        finally:
            docs.unpersist()

    docs = snapshot_stream(spark, source_dir, max_files_per_trigger, SNAPSHOT_FOR_RECORDS)
    return started(docs.writeStream.foreachBatch(write), checkpoint, trigger, available_now)
