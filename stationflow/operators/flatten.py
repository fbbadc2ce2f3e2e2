"""Raw snapshot documents → flat rows (unnest, rename, cast) and dimension builds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.schemas import REALTIME_COLUMNS, RECORD_COLUMNS, RECORD_SOURCE, STATION_COLUMNS


def _station_id(strict: bool):
    libelle = F.col("r.fields.libelle")
    # ANSI cast fails the job on non-numeric text, like the warehouse; try_cast
    # turns it into null, which the not-null filter of the load then drops.
    return libelle.cast("bigint") if strict else libelle.try_cast("bigint")


def explode_records(snapshots: DataFrame, keep_empty: bool = False) -> DataFrame:
    """``FROM raw, UNNEST(records) AS r``: one row per station record.

    Inner semantics by default (null or empty ``records`` vanish); with
    ``keep_empty`` such documents yield one row with a null ``r``.
    """
    gen = F.explode_outer if keep_empty else F.explode
    return snapshots.select(gen("records").alias("r"))


def flatten_snapshots(snapshots: DataFrame, strict: bool = True) -> DataFrame:
    """Raw snapshots → the 7 ``records`` columns, canonical names and types."""
    r = explode_records(snapshots)
    return r.select(
        _station_id(strict).alias("station_id"),
        F.col("r.fields.etat").alias("operational_state"),
        F.col("r.fields.nbvelosdispo").cast("bigint").alias("nb_available_bikes"),
        F.col("r.fields.nbplacesdispo").cast("bigint").alias("nb_available_places"),
        F.col("r.fields.etatconnexion").alias("connexion"),
        F.col("r.fields.datemiseajour").alias("last_update"),
        F.col("r.record_timestamp").alias("record_timestamp"),
    ).select(*RECORD_COLUMNS)


def flatten_realtime(snapshots: DataFrame, strict: bool = True) -> DataFrame:
    """Raw snapshots → 13-column realtime rows (dimension + reading)."""
    r = explode_records(snapshots)
    loc = F.col("r.fields.localisation")
    return r.select(
        F.col("r.fields.nom").alias("name"),
        _station_id(strict).alias("id"),
        F.col("r.fields.adresse").alias("adress"),
        F.col("r.fields.commune").alias("city"),
        F.col("r.fields.type").alias("type"),
        F.get(loc, 0).cast("double").alias("latitude"),
        F.get(loc, 1).cast("double").alias("longitude"),
        F.col("r.fields.etat").alias("operational_state"),
        F.col("r.fields.nbvelosdispo").cast("bigint").alias("nb_available_bikes"),
        F.col("r.fields.nbplacesdispo").cast("bigint").alias("nb_available_places"),
        F.col("r.fields.etatconnexion").alias("connexion"),
        F.col("r.fields.datemiseajour").alias("last_update"),
        F.col("r.record_timestamp").alias("record_timestamp"),
        F.col("r.fields.libelle").alias("libelle"),
    )


def latest_per_key(df: DataFrame, key: str, order: Sequence[str],
                   cols: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest ``order`` per ``key`` (an aggregation, so a hot
    key is combined map-side instead of being sorted in one task)."""
    cols = [c for c in (cols or df.columns) if c != key]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]),
                    F.struct(*[F.col(c) for c in order])).alias("__best")
    return df.groupBy(key).agg(best).select(key, *[F.col("__best").getField(c).alias(c)
                                                   for c in cols])


def stations_from_snapshots(snapshots: DataFrame, strict: bool = True) -> DataFrame:
    """Station dimension from raw snapshots: latest description of every id."""
    rows = flatten_realtime(snapshots, strict).where(F.col("id").isNotNull())
    return latest_per_key(rows, "id", ["record_timestamp", "last_update"],
                          STATION_COLUMNS).select(*STATION_COLUMNS)


def realtime_stations(snapshots: DataFrame, station: str | None = None,
                      strict: bool = True) -> DataFrame:
    """Latest 13-column row per station; ``station`` matches ``libelle``
    case-insensitively (compared as text, like the source ids)."""
    rows = flatten_realtime(snapshots, strict)
    if station is not None:
        rows = rows.where(F.lower(F.col("libelle")) == F.lower(F.lit(str(station))))
    rows = rows.where(F.col("id").isNotNull())
    return latest_per_key(rows, "id", ["record_timestamp", "last_update"],
                          REALTIME_COLUMNS).select(*REALTIME_COLUMNS)


def nested_arrays(snapshots: DataFrame) -> DataFrame:
    """Field paths through the ``records`` array without unnesting: one array
    per field and document (what a dotted path on an array of structs yields)."""
    return snapshots.select(*[F.col(f"records.fields.{f}").alias(c) for c, f in RECORD_SOURCE.items()],
                            F.col("records.record_timestamp").alias("record_timestamp"))


def zip_arrays_to_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Parallel arrays → rows: element i of every array becomes row i."""
    return df.select(F.explode(F.arrays_zip(*[F.col(c) for c in cols])).alias("__z")) \
             .select(*[F.col("__z").getField(c).alias(c) for c in cols])


def replicate(df: DataFrame, n: int, index: str = "copy") -> DataFrame:
    """Each row ``n`` times with ``index`` = 1..n (a generated series, no join)."""
    return df.withColumn(index, F.explode(F.sequence(F.lit(1), F.lit(n))))


def rejects(snapshots: DataFrame, corrupt: str = "_corrupt_record") -> DataFrame:
    """What a load can't use, as (reason, detail): ``corrupt`` lines (when the scan kept
    them), documents without records (``empty``) and records whose station id is no
    whole number (``bad_id``, null ids included). ``detail`` is the line, or JSON."""
    records = F.col("records")
    line = F.col(corrupt) if corrupt in snapshots.columns else F.lit(None).cast("string")
    documents = (snapshots.where(line.isNotNull() | records.isNull() | (F.size(records) == 0))
                 .select(F.when(line.isNotNull(), "corrupt").otherwise("empty").alias("reason"),
                         F.coalesce(line, F.to_json(F.struct(records))).alias("detail")))
    ids = (explode_records(snapshots.where(line.isNull())).where(_station_id(strict=False).isNull())
           .select(F.lit("bad_id").alias("reason"), F.to_json("r").alias("detail")))
    return documents.unionByName(ids)


def report_columns(snapshots: DataFrame, corrupt: str = "_corrupt_record") -> list[Column]:
    """The aggregates of ``load_report``, for reports by file or by any other key."""
    broken = F.col(corrupt).isNotNull() if corrupt in snapshots.columns else F.lit(False)
    none = F.col("records").isNull() | (F.size("records") == 0)
    rows = F.when(broken | none, 0).otherwise(F.size("records")).cast("bigint")
    bad = F.when(broken | none, 0).otherwise(F.size(F.filter(
        "records", lambda r: r["fields"]["libelle"].try_cast("bigint").isNull()))).cast("bigint")

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return [F.count(F.lit(1)).alias("documents"), F.count_if(broken).alias("corrupt"),
            F.count_if(~broken & none).alias("empty"), total(rows).alias("station_rows"),
            total(bad).alias("bad_ids"), total(rows - bad).alias("loaded_rows")]


def load_report(snapshots: DataFrame, corrupt: str = "_corrupt_record") -> DataFrame:
    """Documents, what is rejected and why, and station rows, in one pass: ``documents`` =
    ``corrupt`` + ``empty`` + documents with records; ``station_rows`` = ``bad_ids`` +
    ``loaded_rows``."""
    return snapshots.agg(*report_columns(snapshots, corrupt))


def expected_rows(snapshots: DataFrame) -> DataFrame:
    """Documents and station rows they hold (measured, not files × stations)."""
    return snapshots.agg(F.count(F.lit(1)).alias("documents"),
                         F.coalesce(F.sum(F.size("records").cast("bigint")), F.lit(0))
                         .cast("bigint").alias("station_rows"))
