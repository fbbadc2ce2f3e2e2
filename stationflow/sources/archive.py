"""An archive of raw snapshots with one file a capture, named by its local time.

Spark writes a folder for each capture; its file is then moved to ``capture_date=<day>/`` under
the name that tells the capture time, which ``snapshots.with_source_file`` gets back. Moving
is a rename, so no document passes the driver; it costs one call a capture.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.codec import capture_file_name
from stationflow.functions.timefn import DEFAULT_TZ, local_time
from stationflow.session import path_exists
from stationflow.sources.dated import _fs, _names
from stationflow.sources.sinks import JSON_TIMESTAMP_FORMAT

UNKNOWN = "unknown"  # captures without a time
MOVERS = 16


def archive_captures(snapshots: DataFrame, path: str, captured_at: str = "captured_at", tz: str = DEFAULT_TZ,
                     batch: str | None = None) -> None:
    """Add documents to the archive, one file a capture instant (``captured_at``, not stored in the
    documents) with a document a line.

    The hour that an autumn change repeats has its own names. A capture that is there
    already, or that Spark splits for its size, gets another file of the same time. Called
    again with the same ``batch`` after a failure, it goes on where it stopped; after it has
    ended, it adds nothing. Documents without a capture time go to ``capture_date=unknown``."""
    spark = snapshots.sparkSession
    batch = batch or uuid.uuid4().hex[:12]
    staged = f"{path}/_staged/{batch}"
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        at = F.col(captured_at)
        day = F.coalesce(F.date_format(local_time(at, tz), "yyyy_MM_dd"), F.lit(UNKNOWN))
        named = F.coalesce(capture_file_name(at, tz), F.lit(f"{UNKNOWN}.json"))
        docs = snapshots.select(*[c for c in snapshots.columns if c != captured_at],
                                day.alias("capture_date"), named.alias("source_file"))
        (docs.hint("rebalance", "source_file").write.mode("overwrite")
         .option("partitionOverwriteMode", "static").option("timestampFormat", JSON_TIMESTAMP_FORMAT)
         .partitionBy("capture_date", "source_file").json(staged))
    _move(spark, staged, path, batch)


def _move(spark: SparkSession, staged: str, path: str, batch: str) -> None:
    for day in _names(spark, staged):
        if not day.startswith("capture_date="):
            continue
        fs, target = _fs(spark, f"{path}/{day}")
        fs.mkdirs(target)

        def move(folder: str, day=day) -> None:
            name = folder.partition("=")[2]
            for n, part in enumerate(p for p in _names(spark, f"{staged}/{day}/{folder}") if not p.startswith("_")):
                source = f"{staged}/{day}/{folder}/{part}"
                other = f"{name.removesuffix('.json')}.{batch}-{part.split('-')[1]}-{n}.json"
                if not any(_renamed(spark, source, f"{path}/{day}/{to}") for to in (name, other)):
                    raise OSError(f"could not move {source} to {path}/{day}")

        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(move, _names(spark, f"{staged}/{day}")))


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    fs, old = _fs(spark, source)
    new = _fs(spark, target)[1]
    return not fs.exists(new) and fs.rename(old, new)
