"""CSV scans with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stationflow.schemas import TIMEMAP


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TIMEMAP,
             header: bool = True) -> DataFrame:
    """Header CSV with a declared schema (columns matched by name)."""
    return (spark.read.option("header", header).option("enforceSchema", False)
            .schema(schema).csv(path))
