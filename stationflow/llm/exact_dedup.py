"""Exact de-duplication by skew-safe combining.

Equal texts are merged three times, each time under the full content:

1. locally: the map-side half of the salted aggregation combines equal texts of one
   task before anything is shuffled;
2. by (digest, content, salt): the salt comes from the row id, so a text that makes up
   a third of all rows is merged by ``salts`` tasks instead of one;
3. by (digest, content): at most ``salts`` winners a text are left to combine.

The winners are then attached to the rows over narrow columns only. Two contents that
shared a SHA-256 would still be told apart there by a second hash and the length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS


def without_blanks(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                salts: int = 16) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after deleting space, tab, LF, VT, FF and CR. The
    row with the most code points in its original text stays; of ties the smallest id;
    a null id loses against any other. A null text counts as empty; empty texts form
    one group. Rows repeated with the same id and text each count in ``group_size``;
    if theirs is the id that stays, each of them says so. An empty table gives no rows.
    Columns other than the two named are not read."""
    norm = without_blanks(F.col(text))
    rows = docs.select(F.col(doc_id).alias("id"), norm.alias("content"),
                       F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("points"))
    rows = rows.select("id", "content", "points", F.sha2("content", 256).alias("digest"),
                       F.pmod(F.xxhash64("id", "points"), F.lit(salts)).alias("salt"))
    best = F.min(F.struct(-F.col("points"), F.col("id").isNull(), "id"))
    salted = (rows.groupBy("digest", "content", "salt")
              .agg(best.alias("best"), F.count(F.lit(1)).alias("n")))
    groups = (salted.groupBy("digest", "content")
              .agg(F.min("best").alias("best"), F.sum("n").alias("n"))
              .select("digest", F.xxhash64("content").alias("check"),
                      F.octet_length("content").alias("bytes"),
                      F.col("best.id").alias("keep_id"), F.col("n").alias("group_size")))
    narrow = rows.select("id", "digest", F.xxhash64("content").alias("check"),
                         F.octet_length("content").alias("bytes"))
    return (narrow.join(groups, ["digest", "check", "bytes"], "left")
            .select(F.col("id").alias(doc_id), "keep_id", "group_size",
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("digest").alias("text_sha256")))
