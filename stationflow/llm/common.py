"""Helpers shared by the operators: tables, row keys, ASCII case folding, splits."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Java and Python spell this class alike: space, tab, LF, VT, FF, CR.
BLANKS = r"[\x20\x09-\x0D]"
BLANK_LETTERS = " \t\n\x0b\x0c\r"

ROW_ID, ROW_TEXT = "__row_id", "__row_text"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays. ``lower`` does just that on pure
    ASCII text and is much faster than ``translate``."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, UPPER.lower())))


def blank_words(text: Column) -> Column:
    """Non-empty runs of characters that are not blanks; null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), BLANKS + "+")
    return F.filter(parts, lambda w: w != "")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in no fold (-1)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1)).cast("int")


def sampled(rows: DataFrame, count: int, salt: int = 0, key: str = "id") -> DataFrame:
    """``count`` rows at most, the first by a hash of ``key``: the same ones each time.

    Rows beyond the share that is surely enough are filtered out where they are read, so
    that the tasks together hand little more than ``count`` rows to the one that sorts."""
    n = rows.count()
    order = F.xxhash64(key, F.lit(salt))
    if n > count:
        parts = 1 << 30
        rows = rows.where(F.pmod(order, F.lit(parts)) < int(min(parts, parts * (count + 6 * count ** 0.5 + 10) / n)))
    return rows.orderBy(F.pmod(order, F.lit(1 << 30)), key).limit(count)


def keyed(df: DataFrame, doc_id: str, text: str, *more: Column) -> DataFrame:
    """The row key and the text, nothing else: the id and a 64-bit hash of the text.

    Rows that agree in both are the same document, so every operator gives them
    the same answer. All other columns are left out, whatever they are called."""
    return df.select(F.col(doc_id).alias(ROW_ID), F.xxhash64(F.col(text)).alias(ROW_TEXT),
                     F.col(text).alias("__text"), *more)


def join_rows(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Equi-join on the row key; null ids match each other. For inner and left
    joins the key of the left side is kept."""
    a, b = left.alias("__l"), right.alias("__r")
    on = (F.col(f"__l.{ROW_ID}").eqNullSafe(F.col(f"__r.{ROW_ID}"))
          & (F.col(f"__l.{ROW_TEXT}") == F.col(f"__r.{ROW_TEXT}")))
    joined = a.join(b, on, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select("__l.*", *[F.col(f"__r.{c}") for c in right.columns
                                    if c not in (ROW_ID, ROW_TEXT)])


def with_row_key(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.withColumn(ROW_ID, F.col(doc_id)).withColumn(ROW_TEXT, F.xxhash64(F.col(text)))


def drop_row_key(df: DataFrame) -> DataFrame:
    return df.drop(ROW_ID, ROW_TEXT)


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Rows and bytes per Arrow batch, so that a Python worker holds a few MB of text at a time,
    however long single texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor and the driver see: spark.checkpoint.dir."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(path)
    return path


def stored_at(df: DataFrame, name: str, compression: str = "snappy") -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it back, with its path: the lineage is
    cut, and a lost executor costs a re-read instead of a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{os.urandom(8).hex()}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    return stored_at(df, name, compression)[0]


BROADCAST_KEYS = 1_000_000


def join_small(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``join_rows`` with a stored table of few columns, broadcast if it has no more than
    BROADCAST_KEYS rows; beyond that both sides are shuffled."""
    return join_rows(rows, F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, how)
