"""Date-partitioned tables whose dates are replaced at one instant.

A table is a folder of Parquet files, ``<path>/gen=<generation>/record_date=<day>/``, and a
small list that names the generation of every replaced day (all others are in the first
one): ``<path>/_dates/<number>.json``, of which the highest counts. A replacement writes the
new content of its days as a generation that nobody reads yet. Writing the next list is the
one step that makes all of its days visible, so a reader sees the old rows or the new ones.

Writers don't wait for each other:

* ``append`` moves finished files into the generations that count and looks afterwards whether
  a replacement has come between; if so, it moves its files on.
* ``replace`` compares the files of its days before and after it has read them and begins
  again if they differ. What an append has added between that and the switch is moved into
  the new generation, so it isn't lost either.
* Lists are created, never overwritten: of two replacements that end at once, one begins again.

Replaced generations stay until ``clean``, for readers that have begun.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.schemas import RECORD_DATE, RECORDS
from stationflow.session import delete_path, path_exists

GENERATION = "gen"
FIRST = "0"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
ATTEMPTS = 8


class Conflict(RuntimeError):
    """Other writers changed the days of a replacement again and again."""


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _names(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder, with the lengths of files; none if it doesn't exist."""
    fs, folder = _fs(spark, path)
    if not fs.exists(folder):
        return {}
    return {f.getPath().getName(): f.getLen() for f in fs.listStatus(folder)
            if not f.getPath().getName().startswith(".")}


def _day(value: dt.date | None) -> str:
    return NO_DATE if value is None else value.isoformat()


def _folder(path: str, generation: str, day: str) -> str:
    return f"{path}/{GENERATION}={generation}/{RECORD_DATE}={day}"


# --------------------------------------------------------------------------- the list of generations

def _dates(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number of the list that counts and its generations by day. A list that isn't written to
    its end yet doesn't count."""
    numbers = sorted((int(n.partition(".")[0]) for n in _names(spark, f"{path}/_dates") if n.endswith(".json")),
                     reverse=True)
    for n in numbers:
        fs, file = _fs(spark, f"{path}/_dates/{n}.json")
        stream = fs.open(file)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return n, json.loads(text)
        except ValueError:
            continue
    return 0, {}


def _commit(spark: SparkSession, path: str, number: int, dates: dict[str, str]) -> bool:
    """Create list ``number``; False if there is one already."""
    fs, file = _fs(spark, f"{path}/_dates/{number}.json")
    if fs.exists(file):
        return False
    try:
        stream = fs.create(file, False)
    except Exception as e:  # created by another writer meanwhile
        if "Exists" in str(e) or "exists" in str(e):
            return False
        raise
    stream.write(bytearray(json.dumps(dates, sort_keys=True).encode()))
    stream.close()
    return True


def version(spark: SparkSession, path: str) -> int:
    """How many replacements the table has had."""
    return _dates(spark, path)[0]


def exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{GENERATION}={FIRST}") or path_exists(spark, f"{path}/_dates")


def adopt(spark: SparkSession, path: str) -> None:
    """Make a plain folder of ``record_date=`` folders the first generation of a table."""
    for name in _names(spark, path):
        if name.startswith(f"{RECORD_DATE}="):
            _rename(spark, f"{path}/{name}", f"{path}/{GENERATION}={FIRST}", name)


# --------------------------------------------------------------------------- reading

def read(spark: SparkSession, path: str, schema: T.StructType = RECORDS) -> DataFrame:
    """The rows that count now, with ``record_date``; filters on it prune folders."""
    _, dates = _dates(spark, path)
    full = T.StructType([f for f in schema.fields if f.name != RECORD_DATE] + [
        T.StructField(GENERATION, T.StringType()), T.StructField(RECORD_DATE, T.DateType())])
    live = [g for g in dict.fromkeys([FIRST, *dates.values()]) if path_exists(spark, f"{path}/{GENERATION}={g}")]
    if not live:
        return spark.createDataFrame([], full).drop(GENERATION)
    rows = (spark.read.schema(full).option("basePath", path)
            .parquet(*[f"{path}/{GENERATION}={g}" for g in live]))
    of: dict[str, list[str]] = {}
    for day, g in dates.items():
        of.setdefault(g, []).append(day)
    day = F.col(RECORD_DATE)

    def among(days: list[str]):
        known = [dt.date.fromisoformat(d) for d in days if d != NO_DATE]
        return F.coalesce(day.isin(known), F.lit(False)) | (day.isNull() & F.lit(NO_DATE in days))

    # Both are partition columns, so folders that don't count aren't listed for the scan.
    keep = (F.col(GENERATION) == FIRST) & ~among(list(dates))
    for g, days in of.items():
        keep = keep | ((F.col(GENERATION) == g) & among(days))
    return rows.where(keep).drop(GENERATION)


# --------------------------------------------------------------------------- writing

def _write(rows: DataFrame, path: str) -> None:
    (rows.hint("rebalance", RECORD_DATE).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(RECORD_DATE).parquet(path))


def append(rows: DataFrame, path: str, name: str | None = None, staged: str | None = None) -> None:
    """Add rows (with ``record_date``).

    They are written to ``staged`` first; then the files move in under ``name``. Called again
    with both after a failure, it goes on where it stopped and adds nothing twice."""
    spark = rows.sparkSession
    name = name or uuid.uuid4().hex
    staged = staged or f"{path}/_staged/{name}"
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        _write(rows, staged)
    move_in(spark, staged, path, name)


def move_in(spark: SparkSession, staged: str, path: str, name: str) -> None:
    """Move the files of a finished, date-partitioned folder into the table."""
    fs, root = _fs(spark, path)
    fs.mkdirs(_fs(spark, f"{path}/{GENERATION}={FIRST}")[1])
    for folder in _names(spark, staged):
        if not folder.startswith(f"{RECORD_DATE}="):
            continue
        day = folder.partition("=")[2]
        for part in _names(spark, f"{staged}/{folder}"):
            if part.startswith("_"):
                continue
            at, file = f"{staged}/{folder}/{part}", f"{name}-{part}"
            while True:
                _, dates = _dates(spark, path)
                to = _folder(path, dates.get(day, FIRST), day)
                _rename(spark, at, to, file)
                if _dates(spark, path)[1].get(day, FIRST) == dates.get(day, FIRST):
                    break
                at = f"{to}/{file}"  # a replacement has come between: move on


def _rename(spark: SparkSession, source: str, folder: str, name: str) -> None:
    fs, old = _fs(spark, source)
    new = _fs(spark, f"{folder}/{name}")[1]
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new) and fs.exists(old):  # else it was moved by the replacement
        raise OSError(f"could not move {source} to {folder}/{name}")


def replace(spark: SparkSession, path: str, dates: Iterable[dt.date | None],
            build: Callable[[DataFrame], DataFrame], schema: T.StructType = RECORDS) -> int:
    """Make ``build(rows that count now)`` the whole content of ``dates`` (None: rows without a
    date), at one instant; returns the number of the new version. Rows that it makes for
    other dates are an error of the caller's and would not be seen."""
    days = sorted({_day(d) for d in dates})
    for _ in range(ATTEMPTS):
        number, before = _dates(spark, path)
        folders = {d: _folder(path, before.get(d, FIRST), d) for d in days}
        seen = {d: _names(spark, f) for d, f in folders.items()}
        generation = uuid.uuid4().hex[:12]
        target = f"{path}/{GENERATION}={generation}"
        try:
            _write(build(read(spark, path, schema)), target)
        except PySparkException:
            if _dates(spark, path)[0] == number:
                raise
            continue  # files that it read were replaced and cleaned away
        if {d: _names(spark, f) for d, f in folders.items()} != seen:
            delete_path(spark, target)
            continue
        while True:
            now, current = _dates(spark, path)
            if any(current.get(d) != before.get(d) for d in days):
                break  # another replacement of these days: begin again
            if _commit(spark, path, now + 1, current | {d: generation for d in days}):
                for d, folder in folders.items():
                    for late in _names(spark, folder).keys() - seen[d].keys():
                        _rename(spark, f"{folder}/{late}", _folder(path, generation, d), late)
                return now + 1
        delete_path(spark, target)
    raise Conflict(f"{path}: {days[0]} to {days[-1]} changed during each of {ATTEMPTS} attempts")


def clean(spark: SparkSession, path: str) -> int:
    """Delete replaced folders, older lists and staged rests; returns how many folders went.
    Only call it when no reader of an older version and no writer is at work."""
    number, dates = _dates(spark, path)
    gone = 0
    for name in _names(spark, path):
        if not name.startswith(f"{GENERATION}="):
            continue
        g = name.partition("=")[2]
        for folder in _names(spark, f"{path}/{name}"):
            if folder.startswith(f"{RECORD_DATE}=") and dates.get(folder.partition("=")[2], FIRST) != g:
                delete_path(spark, f"{path}/{name}/{folder}")
                gone += 1
        if g != FIRST and g not in dates.values():
            delete_path(spark, f"{path}/{name}")
    for name in _names(spark, f"{path}/_dates"):
        if name != f"{number}.json":
            delete_path(spark, f"{path}/_dates/{name}")
    delete_path(spark, f"{path}/_staged")
    return gone
