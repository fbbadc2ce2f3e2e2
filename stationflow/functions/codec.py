"""Name and payload codecs: file names, JSON text, base64 messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.schemas import SNAPSHOT_FILE_PREFIX, SNAPSHOT_FILE_TIME_FORMAT


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sanitize_name(col) -> Column:
    """Replace ':' and '-' by '_' (object names that Hadoop paths accept)."""
    return F.translate(_c(col), ":-", "__")


def snapshot_file_name(local_capture) -> Column:
    """``data___YYYY_MM_DD_HH_MM_SS.json`` from a local capture time."""
    return F.concat(F.lit(SNAPSHOT_FILE_PREFIX),
                    F.date_format(_c(local_capture), SNAPSHOT_FILE_TIME_FORMAT),
                    F.lit(".json"))


SECOND = "__2"  # marks the second of two equal wall-clock times


def capture_file_name(instant, tz: str = "Europe/Paris") -> Column:
    """The snapshot file name of a UTC instant; times that an autumn change repeats are marked."""
    at = _c(instant)
    local = F.from_utc_timestamp(at, tz)
    name = snapshot_file_name(local)
    marked = F.concat(F.substring_index(name, ".json", 1), F.lit(SECOND + ".json"))
    return F.when(F.to_utc_timestamp(local, tz) == F.date_trunc("microsecond", at), name).otherwise(marked)


def file_basename(path_col) -> Column:
    return F.regexp_extract(_c(path_col), r"([^/]+)$", 1)


def capture_time_from_name(name_col, tz: str = "Europe/Paris") -> Column:
    """UTC instant encoded in a snapshot file name (local capture time). Of two instants with one
    wall-clock time it is the first, or the second where the name is marked."""
    stamp = F.regexp_extract(_c(name_col), r"(\d{4}_\d{2}_\d{2}_\d{2}_\d{2}_\d{2})", 1)
    local = F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit(SNAPSHOT_FILE_TIME_FORMAT))
    first = F.to_utc_timestamp(local, tz)
    # The wall clock a few hours later lies behind the change, so its offset is the later one.
    hours = F.make_dt_interval(hours=F.lit(6))
    second = F.to_utc_timestamp(local + hours, tz) - hours
    return F.when(F.contains(_c(name_col), F.lit(SECOND + ".")), second).otherwise(first)


def json_field(col, field: str, ddl_type: str = "bigint") -> Column:
    """One top-level field of a JSON object held as text."""
    return F.from_json(_c(col), f"`{field}` {ddl_type}").getField(field)


def decode_base64_text(col) -> Column:
    """Message payload: base64 text → UTF-8 string."""
    return F.unbase64(_c(col)).cast("string")
