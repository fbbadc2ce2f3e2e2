"""Declared schemas of the data model (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's, in natural order.
# Operational states of a station, as published by the open-data feed.
STATE_IN_SERVICE = "EN SERVICE"
STATE_MAINTENANCE = "IN_MAINTENANCE"
STATE_REFORMED = "RÉFORMÉ"
# Weekday names to the warehouse DAYOFWEEK index (Sunday = 1).
WEEKDAY_INDEX = {"Sunday": 1, "Monday": 2, "Tuesday": 3, "Wednesday": 4,
                 "Thursday": 5, "Friday": 6, "Saturday": 7}
# Plausibility band of the network bike total, exclusive bounds.
NETWORK_BAND = (1500, 2300)
MINUTES_PER_DAY = 1440
# Raw snapshot file names: prefix + local capture time, ':' and '-' replaced by '_'.
SNAPSHOT_FILE_PREFIX = "data___"
SNAPSHOT_FILE_TIME_FORMAT = "yyyy_MM_dd_HH_mm_ss"
# The field and column names of the schemas below are fixed values too.
# ---------------------------------------------------------------------------

# Raw snapshot document: one JSON object per file and minute.
SNAPSHOT_FIELDS = T.StructType([
    T.StructField("nbvelosdispo", T.IntegerType()),
    T.StructField("nbplacesdispo", T.IntegerType()),
    T.StructField("libelle", T.StringType()),
    T.StructField("adresse", T.StringType()),
    T.StructField("nom", T.StringType()),
    T.StructField("etat", T.StringType()),
    T.StructField("commune", T.StringType()),
    T.StructField("etatconnexion", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("geo", T.ArrayType(T.DoubleType())),
    T.StructField("localisation", T.ArrayType(T.DoubleType())),
    T.StructField("datemiseajour", T.TimestampType()),
])

SNAPSHOT_RECORD = T.StructType([
    T.StructField("datasetid", T.StringType()),
    T.StructField("recordid", T.StringType()),
    T.StructField("fields", SNAPSHOT_FIELDS),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ])),
    T.StructField("record_timestamp", T.TimestampType()),
])

SNAPSHOT = T.StructType([
    T.StructField("nhits", T.IntegerType()),
    T.StructField("parameters", T.StructType([
        T.StructField("dataset", T.StringType()),
        T.StructField("rows", T.IntegerType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("format", T.StringType()),
        T.StructField("timezone", T.StringType()),
    ])),
    T.StructField("records", T.ArrayType(SNAPSHOT_RECORD)),
])

# Only what the fact table needs: a JSON scan cannot prune nested fields, so the
# loader declares the narrow schema and the parser skips the rest of each record.
SNAPSHOT_FOR_RECORDS = T.StructType([
    T.StructField("records", T.ArrayType(T.StructType([
        T.StructField("fields", T.StructType([
            T.StructField(name, SNAPSHOT_FIELDS[name].dataType)
            for name in ("nbvelosdispo", "nbplacesdispo", "libelle", "etat", "etatconnexion",
                         "datemiseajour")])),
        T.StructField("record_timestamp", T.TimestampType()),
    ]))),
])

# Fact table: one row per station and snapshot.
RECORDS = T.StructType([
    T.StructField("station_id", T.LongType()),
    T.StructField("operational_state", T.StringType()),
    T.StructField("nb_available_bikes", T.LongType()),
    T.StructField("nb_available_places", T.LongType()),
    T.StructField("connexion", T.StringType()),
    T.StructField("last_update", T.TimestampType()),
    T.StructField("record_timestamp", T.TimestampType()),
])
RECORD_COLUMNS = [f.name for f in RECORDS.fields]

# Column of the fact table → field of the feed; ``record_timestamp`` lies beside the fields.
RECORD_SOURCE = {"station_id": "libelle", "operational_state": "etat", "nb_available_bikes": "nbvelosdispo",
                 "nb_available_places": "nbplacesdispo", "connexion": "etatconnexion", "last_update": "datemiseajour"}

# Station dimension (``id`` is the feed's ``libelle``).
STATIONS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("adress", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])
STATION_COLUMNS = [f.name for f in STATIONS.fields]

# Realtime station row: dimension + latest reading (13 columns).
REALTIME_COLUMNS = ["name", "id", "adress", "city", "type", "latitude", "longitude",
                    "operational_state", "nb_available_bikes", "nb_available_places",
                    "connexion", "last_update", "record_timestamp"]

# Timemap CSV rows.
TIMEMAP = T.StructType([
    T.StructField("record_timestamp", T.TimestampType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("nb_velos_dispo", T.IntegerType()),
    T.StructField("ratio", T.DoubleType()),
])

# Partition column of the stored fact table.
RECORD_DATE = "record_date"
