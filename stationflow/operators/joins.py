"""Fact × dimension joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_stations(records: DataFrame, stations: DataFrame, how: str = "inner") -> DataFrame:
    """``records ⋈ stations ON id = station_id`` (the comma join's evident intent).

    No hint: the planner broadcasts the dimension when its bytes allow it
    (``autoBroadcastJoinThreshold``), adaptive execution decides again from real sizes."""
    return records.join(stations, records["station_id"] == stations["id"], how)
