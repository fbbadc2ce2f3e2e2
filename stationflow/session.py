"""Spark session settings the library relies on.

Timestamps are stored as UTC instants and every local-time computation names its
zone explicitly, so the session zone is pinned to UTC. ANSI mode stays on (the
Spark 4 default) so a bad cast fails the job the way a warehouse would, and AQE
is on so shuffle partition counts, skewed joins and join strategies are re-planned
from runtime statistics.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Gap filling makes hundreds of rows of one: small inputs of such a stage must not be
    # merged into a few tasks, so every core gets a share of them.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "stationflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only set when given: on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the defaults to an existing session; all of them are runtime settings.
    A session that refuses one of them raises."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, which the session must be built
    with: executors on other machines have to see what is written there."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise ValueError("build the session with spark.checkpoint.dir set to a folder "
                         "that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables, under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any file system that Spark knows; missing ones are fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
