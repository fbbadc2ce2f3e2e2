"""Previous/next row along time without a window over a whole key.

``lag``/``lead`` over ``PARTITION BY station ORDER BY ts`` puts one station's
entire history into one window partition: a hot key then lands in one task.
``adjacent`` splits every key into time buckets (an hour, a day). Inside a bucket
the neighbour comes from an ordinary window; the rows at a bucket edge get it from
a small table of one row per (key, bucket) — the bucket's last (or first) row —
shifted by one bucket. The result equals the unbucketed window function, while no
window partition holds more than one bucket of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "__adj_bucket"
_EDGE = "__adj_edge"
_CARRY = "__adj_carry"


def adjacent(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
             cols: Sequence[str], direction: str = "prev", name: str = "adjacent") -> DataFrame:
    """Add ``name``: a struct of ``cols`` taken from the previous (``"prev"``) or
    next (``"next"``) row of the same ``keys`` in ``order``; null at the ends.

    ``bucket`` must not decrease along ``order`` within a key (e.g. the hour or the
    day of the ordering timestamp). ``order`` should be unique within a key,
    otherwise ties are resolved arbitrarily, as with a window function. Keys must
    not be null.
    """
    if direction not in ("prev", "next"):
        raise ValueError("direction must be 'prev' or 'next'")
    keys, order, cols = list(keys), list(order), list(cols)
    shift = F.lag if direction == "prev" else F.lead
    payload = F.struct(*[F.col(c) for c in cols])
    ordering = F.struct(*[F.col(c) for c in order])

    d = df.withColumn(_BUCKET, bucket)
    inner = Window.partitionBy(*keys, _BUCKET).orderBy(*order)
    d = d.withColumn(name, shift(payload, 1).over(inner))

    # One row per (key, bucket): the row a neighbouring bucket needs.
    if cols == order and len(cols) == 1:
        # Payload is the ordering column itself: a plain max/min (hash aggregate).
        extreme = F.max if direction == "prev" else F.min
        edge = F.struct(extreme(F.col(cols[0])).alias(cols[0]))
    else:
        edge = F.max_by(payload, ordering) if direction == "prev" else F.min_by(payload, ordering)
    edges = d.groupBy(*keys, _BUCKET).agg(edge.alias(_EDGE))
    across = Window.partitionBy(*keys).orderBy(_BUCKET)
    edges = edges.select(*keys, _BUCKET, shift(_EDGE, 1).over(across).alias(_CARRY))

    d = d.join(edges, on=[*keys, _BUCKET], how="left")
    # A row inside a bucket always has a non-null struct; only edge rows fall back.
    return d.withColumn(name, F.coalesce(F.col(name), F.col(_CARRY))).drop(_BUCKET, _CARRY)


def with_next_minute(df: DataFrame, keys: Sequence[str], values: Sequence[str], minute: str = "minute",
                     name: str = "__next", first: str | None = None) -> DataFrame:
    """Rows with the next minute of their key as ``name`` (null for the last one) and, when
    ``first`` names a column, the first minute of the key. ``df`` has at most one row for
    each key and minute, and is read once.

    The rows of a key and UTC day are at most 1440 and become one sorted array, in which
    the neighbour is the next element. Only the first minute of the following day comes
    from a window, over one narrow row for each key and day."""
    keys, values = list(keys), list(values)
    rows = F.array_sort(F.collect_list(F.struct(minute, *values)))
    days = df.groupBy(*keys, F.date_trunc("day", F.col(minute)).alias("__day")).agg(rows.alias("__rows"))
    along = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("__day")
    edges = (df.groupBy(*keys, F.date_trunc("day", F.col(minute)).alias("__day")).agg(F.min(minute).alias("__first"))
             .select(*keys, "__day", F.lead("__first").over(along).alias("__after"),
                     F.min("__first").over(along).alias("__start")))
    days = days.join(edges, [*keys, "__day"])
    each = F.transform("__rows", lambda r, i: F.struct(r.alias("r"), F.coalesce(
        F.get("__rows", i + 1)[minute], F.col("__after")).alias("next")))
    more = [F.col("__start").alias(first)] if first else []
    out = days.select(*keys, "__start", F.explode(each).alias("__e"))
    return out.select(*keys, F.col("__e.r")[minute].alias(minute), *[F.col("__e.r")[v].alias(v) for v in values],
                      F.col("__e.next").alias(name), *more)
