"""Connected components of a table of links, by alternating large-star and small-star.

Each round relinks every node to the smallest one it can see, until nothing changes. A
round is two aggregations and two joins; its result is written to the shared folder, so
the lineage stays short, and the table of the round before is deleted. Nothing but a
count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.session import delete_path

from .common import stored_at


def _sum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; the root is the smallest node that can be
    reached. Links of a node to itself, repeated ones and ones with a null are ignored.
    No links give no rows."""
    links = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where((F.col(a) != F.col(b))).distinct())
    links, path = stored_at(links, "links")
    before = _sum(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        links, new = stored_at(small, "links")
        after = _sum(links)
        delete_path(links.sparkSession, path)
        path = new
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
