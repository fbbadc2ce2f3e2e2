"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

A fingerprint has 64 bits, cut into segments of 22, 21 and 21. Of two fingerprints that
differ in at most two bits, one segment is equal (pigeonhole), and the next one differs
in at most two bits, so that it has a Golay key in common. The join key is (which
segment, its bits, a Golay key of the next one): 33 to 34 bits, about sixteen keys a
fingerprint. Distinct fingerprints are joined on it and verified by counting bits, so
copies never meet each other.

A bucket of more than ``pair_limit`` distinct fingerprints is not paired. Its members
go the other exact way: each is listed under itself and its 64 one-bit neighbours, and
whoever shares such a word (never more than 65 fingerprints) is linked to the smallest
of them. Two fingerprints share a word exactly if they differ in at most two bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW_ID, ROW_TEXT, join_small, keyed, small_batches, stored, with_row_key
from .components import connected_components
from .golay import keys

SEGMENTS = ((0, 22), (22, 21), (43, 21))
MAX_BITS = 2


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority of the bits of the XXH64 of every shingle, as an unsigned number."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII rules, being bytes
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    ones, block = np.zeros(64, np.int64), 1 << 15
    for start in range(0, count, block):
        part = words[start:start + block + shingle - 1]
        runs = zip(*(part[o:] for o in range(shingle))) if len(words) >= shingle else [words]
        hashes = np.array([xxh64_intdigest(b" ".join(run), seed) for run in runs], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                 seed: int = 42) -> DataFrame:
    """Row key and fingerprint (``fp``, a signed long) of every row."""
    rows = keyed(docs, doc_id, text)
    schema = T.StructType([rows.schema[ROW_ID], rows.schema[ROW_TEXT], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in pdf["__text"]], np.uint64)
            yield pdf[[ROW_ID, ROW_TEXT]].assign(fp=fps.view(np.int64))

    small_batches(docs.sparkSession)
    return rows.mapInPandas(run, schema)


def _key_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        fps = pdf["fp"].to_numpy(np.int64)
        bits = fps.view(np.uint64)
        segs = [(bits >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1) for at, width in SEGMENTS]
        for i in range(len(SEGMENTS)):
            row, key = keys(segs[(i + 1) % len(SEGMENTS)])
            yield pd.DataFrame({"fp": fps[row], "key": (i << 34) | (segs[i][row] << 12) | key.astype(np.int64)})


def links(fps: DataFrame, pair_limit: int = 64) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` at two or fewer
    differing bits. Fingerprints of large buckets are linked by way of the smallest."""
    listed = fps.mapInPandas(_key_rows, "fp bigint, key bigint")
    listed = stored(listed, "golay-keys")
    sizes = listed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = listed.join(sizes, "key")
    low = buckets.where(F.col("n") <= pair_limit).select("key", "fp")
    pairs = (low.alias("l").join(low.alias("r"), F.col("l.key") == F.col("r.key"))
             .where((F.col("l.fp") < F.col("r.fp"))
                    & (F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= MAX_BITS))
             .select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")))
    crowded = buckets.where(F.col("n") > pair_limit).select("fp").distinct()
    near = crowded.select("fp", F.explode(F.expr(
        "concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("word"))
    least = (near.groupBy("word").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("word", "least"))
    stars = near.join(least, "word").where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(stars)


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                   seed: int = 42, pair_limit: int = 64) -> DataFrame:
    """Row key, ``fp`` and ``least``: the smallest row of the component as a struct
    (no id, id, hash of the text)."""
    rows = stored(fingerprints(docs, doc_id, text, shingle, seed), "fingerprints")
    first = F.min(F.struct(F.col(ROW_ID).isNull().alias("no_id"), ROW_ID, ROW_TEXT))
    distinct = rows.groupBy("fp").agg(first.alias("least"))
    roots = connected_components(links(distinct.select("fp"), pair_limit))
    named = (distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    least = named.groupBy("root").agg(F.min("least").alias("least"))
    return rows.join(named.select("fp", "root").join(least, "root").select("fp", "least"), "fp")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                       seed: int = 42, pair_limit: int = 64) -> DataFrame:
    """One row per document row: id, ``fingerprint`` (16 hex digits), ``component_id``.

    Words are runs of characters other than blanks, A-Z lower-cased; shingles are
    ``shingle`` consecutive words, repeats included (fewer words: all of them). A null,
    empty or blank text has fingerprint zero and is linked like any other. Fingerprints
    link at two or fewer differing bits; ``component_id`` is the smallest id that links
    reach, null ids aside (null if there are no others). Repeated rows keep their number.
    An empty table gives no rows. Other columns are not read."""
    groups = simhash_groups(docs, doc_id, text, shingle, seed, pair_limit)
    return groups.select(F.col(ROW_ID).alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         F.col(f"least.{ROW_ID}").alias("component_id"))


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
               **params) -> DataFrame:
    """The documents, all columns: of each component one row, that with the smallest id (null
    ids last). Of rows repeated with one id and text any one is kept. Null and empty texts are
    one component; an empty table gives no rows."""
    groups = simhash_groups(docs, doc_id, text, shingle, **params)
    key = F.struct(F.col(ROW_ID).isNull().alias("no_id"), ROW_ID, ROW_TEXT)
    rows = stored(groups.groupBy(ROW_ID, ROW_TEXT).agg(
        F.max((key == F.col("least")).cast("int")).alias("first"), F.count(F.lit(1)).alias("n")), "near-rows")
    # Rows that go, and rows that come more than once, are few; all others stay where they are.
    away = rows.where("first = 0 or n > 1").select(ROW_ID, ROW_TEXT)
    repeated = rows.where("first = 1 and n > 1").select(ROW_ID, ROW_TEXT)
    full = with_row_key(docs, doc_id, text)
    once = join_small(full, away, "left_anti").select(*docs.columns)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = (join_small(full, repeated, "left_semi").groupBy(ROW_ID, ROW_TEXT)
           .agg(F.any_value(row).alias("__row")).select("__row.*"))
    return once.unionByName(one)
