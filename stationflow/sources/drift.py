"""Feeds that change their fields: loads by VARIANT, and a report of what differs.

A declared schema drops fields that it doesn't know and makes null of values of another type.
Here a document is parsed once to a VARIANT. Declared fields are taken from it by path and cast
(a number that comes as text is still that number), what isn't declared is kept with its
record as JSON text, and the report counts each path and type that the schema doesn't say.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.schemas import (RECORD_COLUMNS, RECORD_SOURCE, RECORDS, SNAPSHOT, SNAPSHOT_FIELDS,
                                 SNAPSHOT_RECORD)

DEPTH = 8  # levels that the report goes down; deeper ones count as one object or array
KINDS = {dict: "object", list: "array", str: "text", bool: "boolean", int: "number", float: "number"}


def read_variants(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row a line: ``raw`` (VARIANT, null for a line that is no JSON) and ``line`` (the text of
    such a line, else null)."""
    lines = spark.read.text(list(paths) if not isinstance(paths, str) else paths).where("trim(value) <> ''")
    raw = F.try_parse_json("value")
    return lines.select(raw.alias("raw"), F.when(raw.isNull(), F.col("value")).alias("line"))


def _elements(documents: DataFrame) -> DataFrame:
    """One VARIANT ``r`` for each record; documents without a list of records have none."""
    records = F.try_variant_get(F.col("raw"), "$.records", "array<variant>")
    return documents.select(F.explode(records).alias("r"))


def _as_map(path: str) -> Column:
    return F.try_variant_get(F.col("r"), path, "map<string,variant>")


def flatten_variants(documents: DataFrame) -> DataFrame:
    """The record columns and ``unknown``, a JSON object of what they and the declared schema don't
    hold (null if there is nothing): undeclared ``fields``, or ``fields`` whose value can't be
    cast without a loss (it's null in its column, a fraction is cut), undeclared members of the
    ``record``, or the ``value`` of an element that is no object.

    Lines that are no JSON and documents whose ``records`` are no list give no rows."""
    kinds = {f.name: f.dataType.simpleString() for f in RECORDS.fields}
    r = _elements(documents)
    columns, lost = {}, []
    for c, f in RECORD_SOURCE.items():
        columns[c] = F.try_variant_get(F.col("r"), f"$.fields.{f}", kinds[c])
        given = F.try_variant_get(F.col("r"), f"$.fields.{f}", "string")
        gone = given.isNotNull() & columns[c].isNull()
        if kinds[c] == "bigint":
            gone = gone | (F.try_variant_get(F.col("r"), f"$.fields.{f}", "double") != columns[c].cast("double"))
        lost.append(F.when(gone, F.lit(f)))
    record, fields = _as_map("$"), _as_map("$.fields")
    rows = r.select(*[columns[c].alias(c) for c in RECORD_SOURCE],
                    F.try_variant_get(F.col("r"), "$.record_timestamp", "timestamp").alias("record_timestamp"),
                    F.array_compact(F.array(*lost)).alias("__lost"), record.alias("__record"), fields.alias("__fields"), "r")
    more = F.map_filter("__fields", lambda k, v: ~k.isin(SNAPSHOT_FIELDS.names) | F.array_contains("__lost", k))
    beside = F.map_filter("__record", lambda k, v: ~k.isin(SNAPSHOT_RECORD.names)
                          | ((k == "fields") & F.col("__fields").isNull() & ~F.is_variant_null(v))
                          | ((k == "record_timestamp") & F.col("record_timestamp").isNull() & ~F.is_variant_null(v)))
    plain = F.col("__record").isNull() & ~F.is_variant_null("r")
    unknown = F.struct(F.when(F.size(more) > 0, more).alias("fields"), F.when(F.size(beside) > 0, beside).alias("record"),
                       F.when(plain, F.col("r")).alias("value"))
    text = F.to_json(unknown)  # leaves nulls out
    return rows.select(*RECORD_COLUMNS, F.when(text != "{}", text).alias("unknown"))


def _kinds(t: T.DataType, path: str = "$") -> dict[str, str]:
    """Path → kind of value that the schema says."""
    if isinstance(t, T.StructType):
        out = {path: "object"}
        for f in t.fields:
            out |= _kinds(f.dataType, f"{path}.{f.name}")
        return out
    if isinstance(t, T.ArrayType):
        return {path: "array"} | _kinds(t.elementType, f"{path}[]")
    return {path: "number" if isinstance(t, T.NumericType) else "boolean" if isinstance(t, T.BooleanType) else "text"}


def _drift(value, path: str, declared: dict[str, str], found: Counter, depth: int = DEPTH) -> None:
    """Count (path, kind, status) of what ``declared`` doesn't say of a parsed JSON value."""
    if value is None:
        return
    kind = KINDS[type(value)]
    said = declared.get(path)
    if said != kind:
        found[path, kind, "added" if said is None else "retyped"] += 1
    elif depth > 1 and kind == "object":
        for key, x in value.items():
            _drift(x, f"{path}.{key}", declared, found, depth - 1)
    elif depth > 1 and kind == "array":
        for x in value:
            _drift(x, f"{path}[]", declared, found, depth - 1)


def drift_report(documents: DataFrame, schema: T.StructType = SNAPSHOT) -> DataFrame:
    """``path``, ``kind`` (object, array, number, text, boolean), ``status`` and ``n``: values whose
    path the schema doesn't say (``added``; what lies below isn't listed) or says otherwise
    (``retyped``). Nulls are of any kind. Elements of an array share the path ``[]``.

    Each document is walked once, where it was parsed; a task sends the counts of each batch."""
    declared = _kinds(schema)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = Counter()
            for text in pdf["text"]:
                if text is not None:
                    _drift(json.loads(text), "$", declared, found)
            yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["path", "kind", "status", "n"])

    parts = documents.select(F.to_json("raw").alias("text")).mapInPandas(
        count, "path string, kind string, status string, n bigint")
    return parts.groupBy("path", "kind", "status").agg(F.sum("n").alias("n"))
