"""Adapters from the driver's generated tables to the bike-share data model.

| model column                       | generated table column                    |
|------------------------------------|-------------------------------------------|
| records.station_id                 | events.user_id                            |
| records.record_timestamp, last_update | events.ts (naive UTC)                  |
| records.nb_available_bikes         | floor(events.value)                       |
| records.nb_available_places        | events.props ->> 'k'                      |
| records.operational_state          | events.event_type (mapping below)         |
| records.connexion                  | events.event_type                         |
| stations.id, name, type            | customer.c_custkey, c_name, c_mktsegment  |
| stations.city                      | nation.n_name through c_nationkey         |
| stations.latitude, longitude       | embeddings.embedding[0], [1] (vec_id = id)|
| raw snapshot documents             | records + stations nested per minute      |
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.codec import json_field
from stationflow.schemas import (STATE_IN_SERVICE, STATE_MAINTENANCE, STATE_REFORMED,
                                 RECORD_COLUMNS, STATION_COLUMNS)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed stand-in mapping: event type → operational state.
EVENT_STATE = {"click": STATE_IN_SERVICE, "view": STATE_IN_SERVICE,
               "purchase": STATE_IN_SERVICE, "error": STATE_MAINTENANCE,
               "signup": STATE_REFORMED}
DATASET_ID = "station-realtime"
SNAPSHOT_PAGE_ROWS = 300


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def records_from_events(events: DataFrame) -> DataFrame:
    """``events`` → the 7-column ``records`` fact."""
    et = F.col("event_type")
    state = F.when(et.isin("click", "view", "purchase"), STATE_IN_SERVICE) \
             .when(et == "error", STATE_MAINTENANCE) \
             .when(et == "signup", STATE_REFORMED)
    ts = F.col("ts").cast("timestamp")  # naive UTC wall clock → instant (session zone is UTC)
    return events.select(
        F.col("user_id").alias("station_id"),
        state.alias("operational_state"),
        F.floor("value").cast("bigint").alias("nb_available_bikes"),
        json_field("props", "k", "bigint").alias("nb_available_places"),
        et.alias("connexion"),
        ts.alias("last_update"),
        ts.alias("record_timestamp"),
    ).select(*RECORD_COLUMNS)


def stations_from_tables(customer: DataFrame, nation: DataFrame,
                         embeddings: DataFrame) -> DataFrame:
    """``customer`` (+ ``nation`` name, ``embeddings`` coordinates) → ``stations``."""
    coords = embeddings.select(
        F.col("vec_id").alias("id"),
        F.get(F.col("embedding"), 0).cast("double").alias("latitude"),
        F.get(F.col("embedding"), 1).cast("double").alias("longitude"))
    nat = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    base = customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("adress"), F.col("c_nationkey"),
        F.col("c_mktsegment").alias("type"))
    return (base.join(nat, "c_nationkey", "left")
            .join(coords, "id", "left")
            .select(*STATION_COLUMNS))


def load_model(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(records, stations) over the generated tables of ``sf_dir``."""
    records = records_from_events(load_table(spark, sf_dir, "events"))
    stations = stations_from_tables(load_table(spark, sf_dir, "customer"),
                                     load_table(spark, sf_dir, "nation"),
                                     load_table(spark, sf_dir, "embeddings"))
    return records, stations


def snapshots_from_records(records: DataFrame, stations: DataFrame,
                           page_rows: int = SNAPSHOT_PAGE_ROWS,
                           tz: str = "Europe/Paris") -> DataFrame:
    """Nest readings into raw snapshot documents (``schemas.SNAPSHOT``).

    A document is one capture minute and one page of ``page_rows`` station ids
    (the feed pages its answer the same way, ``parameters.rows``/``start``), so a
    document holds at most ``page_rows`` stations' readings of one minute.
    """
    page = F.floor(F.col("station_id") / page_rows)
    loc = F.array(F.col("latitude"), F.col("longitude"))
    record = F.struct(
        F.lit(DATASET_ID).alias("datasetid"),
        F.hex(F.xxhash64("station_id", "record_timestamp")).alias("recordid"),
        F.struct(
            F.col("nb_available_bikes").cast("int").alias("nbvelosdispo"),
            F.col("nb_available_places").cast("int").alias("nbplacesdispo"),
            F.col("station_id").cast("string").alias("libelle"),
            F.col("adress").alias("adresse"),
            F.col("name").alias("nom"),
            F.col("operational_state").alias("etat"),
            F.col("city").alias("commune"),
            F.col("connexion").alias("etatconnexion"),
            F.col("type").alias("type"),
            loc.alias("geo"),
            loc.alias("localisation"),
            F.col("last_update").alias("datemiseajour"),
        ).alias("fields"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(F.col("longitude"), F.col("latitude")).alias("coordinates")
                 ).alias("geometry"),
        F.col("record_timestamp").alias("record_timestamp"),
    )
    joined = records.join(stations, records["station_id"] == stations["id"], "left")
    docs = (joined
            .groupBy(F.date_trunc("minute", "record_timestamp").alias("capture_minute"),
                     page.alias("page"))
            .agg(F.sort_array(F.collect_list(F.struct(
                F.col("station_id"), F.col("record_timestamp"), record.alias("r")))).alias("items")))
    return docs.select(
        F.size("items").cast("int").alias("nhits"),
        F.struct(F.lit(DATASET_ID).alias("dataset"), F.lit(page_rows).alias("rows"),
                 (F.col("page") * page_rows).cast("int").alias("start"),
                 F.lit("json").alias("format"), F.lit(tz).alias("timezone")).alias("parameters"),
        F.transform("items", lambda x: x["r"]).alias("records"),
        F.col("capture_minute"),
    )
