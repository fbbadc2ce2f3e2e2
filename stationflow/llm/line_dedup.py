"""Line de-duplication by distinct-site spread.

Every distinct line gets a HyperLogLog sketch of the sites that show it. Sketches are
merged by the aggregation itself, so a line that half of all documents carry is a few
sketches per task, not a group of rows. Lines whose estimate is far from the threshold
are decided by it; lines near it get an exact count of distinct sites. Lines shown by
at least ``min_sites`` sites are boilerplate. They stay in the row with the smallest id that
has them, so that no content is lost whole, and leave all other texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_LETTERS, ROW_ID, ROW_TEXT, drop_row_key, join_rows, keyed, stored, with_row_key


def line_array(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_digest(line: Column) -> Column:
    """Digest of a line without blanks around it; null for a blank line."""
    bare = F.trim(line, F.lit(BLANK_LETTERS))
    return F.when(bare != "", F.unhex(F.md5(bare)))


def boilerplate_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      site: str = "source", min_sites: int = 10, lg_k: int = 12,
                      sigmas: float = 6.0) -> DataFrame:
    """Digests of the lines that at least ``min_sites`` distinct sites show, with the row
    of the smallest id that has the line (``first``).

    Near the threshold means within ``sigmas`` standard errors of the sketch
    (1.04 / sqrt(2^lg_k) each), and at least one site away from it."""
    lines = _lines(keyed(docs, doc_id, text, F.col(site).cast("string").alias("site")), "site")
    row = F.struct(F.col(ROW_ID).isNull().alias("no_id"), ROW_ID, ROW_TEXT)
    spread = (lines.where("site is not null").groupBy("digest")
              .agg(F.hll_sketch_agg("site", lg_k).alias("sketch"), F.min(row).alias("first"))
              .select("digest", "first", F.hll_sketch_estimate("sketch").alias("sites")))
    band = max(1.0, sigmas * 1.04 / math.sqrt(2 ** lg_k) * min_sites)
    spread = stored(spread.where(F.col("sites") >= min_sites - band), "line-spread")
    near = spread.where(F.col("sites") < min_sites + band).select("digest", "first")
    exact = (lines.where("site is not null").select("digest", "site")
             .join(near.select("digest"), "digest", "left_semi").distinct()
             .groupBy("digest").agg(F.count(F.lit(1)).alias("sites"))
             .where(F.col("sites") >= min_sites).join(near, "digest").select("digest", "first"))
    far = spread.where(F.col("sites") >= min_sites + band).select("digest", "first")
    return far.unionByName(exact)


def _lines(rows: DataFrame, *keep: str) -> DataFrame:
    return (rows.select(ROW_ID, ROW_TEXT, *keep,
                        F.posexplode(line_array(F.col("__text"))).alias("place", "line"))
            .select(ROW_ID, ROW_TEXT, *keep, "place", line_digest(F.col("line")).alias("digest"))
            .where("digest is not null"))


def _dropped(docs: DataFrame, doc_id: str, text: str, site: str, **params) -> DataFrame:
    """Row key and the positions of the lines to remove."""
    bad = boilerplate_lines(docs, doc_id, text, site, **params)
    elsewhere = ~(F.col(ROW_ID).eqNullSafe(F.col(f"first.{ROW_ID}"))
                  & (F.col(ROW_TEXT) == F.col(f"first.{ROW_TEXT}")))
    return (_lines(keyed(docs, doc_id, text)).join(bad, "digest").where(elsewhere)
            .groupBy(ROW_ID, ROW_TEXT).agg(F.collect_set("place").alias("__places")))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               site: str = "source", **params) -> DataFrame:
    """The documents, all columns, every text without boilerplate lines, and the number
    of removed lines as ``__removed``.

    Sites are values of ``site``; a null site shows nothing. Lines are compared without
    the blanks around them; blank lines are no boilerplate and stay. The rows stay, even
    if no line is left (empty text). A null text stays null. Repeated rows are cleaned
    alike. An empty table stays empty."""
    dropped = _dropped(docs, doc_id, text, site, **params)
    joined = join_rows(with_row_key(docs, doc_id, text), dropped, "left")
    kept = F.filter(F.split(F.col(text), "\n"), lambda line, i: ~F.array_contains("__places", i))
    clean = F.when(F.col("__places").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    removed = F.coalesce(F.size("__places"), F.lit(0)).cast("bigint")
    return drop_row_key(joined.withColumn(text, clean).withColumn("__removed", removed).drop("__places"))
