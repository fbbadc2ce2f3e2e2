"""Catalog tables: create with a fixed schema, stage, back up, count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.schemas import RECORD_COLUMNS, RECORD_DATE, RECORDS, STATIONS


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_records_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``records`` with the declared schema, Parquet, partitioned by date."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(RECORDS)}, `{RECORD_DATE}` date) "
              f"USING parquet PARTITIONED BY ({RECORD_DATE}){loc}")


def create_stations_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(STATIONS)}) USING parquet{loc}")


def insert_records(records: DataFrame, table: str) -> None:
    """Append by position into a partitioned table (columns re-ordered first)."""
    (records.select(*RECORD_COLUMNS, F.to_date("record_timestamp").alias(RECORD_DATE))
     .write.insertInto(table))


def replace_table(df: DataFrame, name: str) -> None:
    """CREATE OR REPLACE TABLE name AS SELECT …"""
    df.write.mode("overwrite").saveAsTable(name)


def backup_table(spark: SparkSession, source: str, backup: str, location: str | None = None) -> None:
    """CREATE TABLE backup AS SELECT * FROM source."""
    options = {"path": location} if location else {}
    spark.table(source).write.mode("errorifexists").options(**options).saveAsTable(backup)


def stage(df: DataFrame, name: str) -> DataFrame:
    """A session-scoped staging table (temp view)."""
    df.createOrReplaceTempView(name)
    return df


def drop_stage(spark: SparkSession, name: str) -> None:
    spark.catalog.dropTempView(name)


def row_count(df: DataFrame) -> DataFrame:
    """SELECT COUNT(*) as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
