"""Benchmark decontamination by winnowing.

Both sides are cut into words. Every run of ``gram`` consecutive words gets a hash, and
of every window of ``window - gram + 1`` neighbouring hashes the smallest is kept as a
fingerprint. A span of ``window`` words decides its fingerprint alone, so a span that a
document shares with an item gives both the same one at the same place: no shared span
of ``window`` words is missed. Documents keep about a third of their positions.

Fingerprints are joined narrowly (row key, position, hash). Only documents with a common
fingerprint are read again, to extend each hit over the words around it and to compare
the words themselves. A shared span needs no more than ``window - gram`` words on either
side, as each of its windows has a fingerprint of its own.

Items of fewer words than a window are looked for whole; documents give the hashes
of such lengths only when there are items of these lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (ROW_ID, ROW_TEXT, drop_row_key, join_rows, join_small, keyed, lower_ascii, stored,
                     with_row_key)

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """Words of lower-cased text: digits, a-z and everything beyond ASCII."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def _grams(hashes: str, length: int) -> Column:
    """Hash of every run of ``length`` words, by its first position (from 0)."""
    n = F.size(hashes)
    return F.when(n >= length, F.transform(
        F.sequence(F.lit(0), n - length),
        lambda i: F.xxhash64(*[F.get(hashes, i + o) for o in range(length)]))
    ).otherwise(F.array().cast("array<bigint>"))


def _least_places(grams: str, span: int) -> Column:
    """Distinct positions of the smallest hash (the leftmost of equals) of every
    ``span`` neighbouring hashes. The lowest bits of each hash give way to its offset,
    so that the smallest value names its place."""
    n, low = F.size(grams), (1 << (span - 1).bit_length()) - 1

    def place(j: Column) -> Column:
        marked = [F.get(grams, j + o).bitwiseAND(F.lit(~low)).bitwiseOR(F.lit(o)) for o in range(span)]
        return j + F.least(*marked).bitwiseAND(F.lit(low)).cast("int")

    return F.when(n >= span, F.array_distinct(F.transform(F.sequence(F.lit(0), n - span), place))
                  ).otherwise(F.array().cast("array<int>"))


def _winnowed(rows: DataFrame, window: int, gram: int, *keep: str) -> DataFrame:
    """``keep``, words, hashes and the fingerprints as structs (len, pos, hash); len is 0
    for a winnowed one."""
    hashed = rows.select(*keep, "words", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    grams = hashed.select("*", _grams("hashes", gram).alias("grams"))
    placed = grams.select("*", _least_places("grams", window - gram + 1).alias("places"))
    # Both arrays are named twice: an array named once would be inlined into the lambda
    # by the optimizer and computed anew for every position.
    marks = F.when((F.size("places") > 0) & (F.size("grams") > 0), F.transform("places", lambda p: F.struct(
        F.lit(0).alias("len"), p.alias("pos"), F.get("grams", p).alias("hash")))
    ).otherwise(F.array().cast("array<struct<len:int,pos:int,hash:bigint>>"))
    return placed.select(*keep, "words", "hashes", marks.alias("marks"))


def _run(hashes: str, start: Column, length: Column) -> Column:
    return F.xxhash64(F.slice(hashes, start + 1, length))


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  window: int = 10, gram: int = 6) -> DataFrame:
    """One row per document row: id, ``n_words``, ``n_hit`` (words inside any occurrence of
    an item window), ``spans`` (ranges of hit word positions, end exclusive), ``item_ids``
    (distinct ids of the items hit, as sorted strings) and ``contaminated``.

    A null or empty text has no words and is clean; an item without words has no
    window. An item with a null id still marks words but is not listed. Items repeated or
    sharing a text are all listed. Rows repeated with one id and text get equal
    answers. Empty tables give clean documents or no rows. Other columns are not read."""
    out = _judged(docs, items, doc_id, text, item_id, item_text, window, gram)
    return out.select(F.col(ROW_ID).alias(doc_id), "n_words", "n_hit", "spans", "item_ids", "contaminated")


def _hits(docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str = "item_id",
          item_text: str = "text", window: int = 10, gram: int = 6) -> DataFrame:
    """Row key, ``n_hit``, ``spans`` and ``item_ids`` of the documents that hold an item window."""
    reach = window - gram
    if not 0 < gram < window:
        raise ValueError("gram must be at least 1 and less than window")
    item_words = items.select(F.col(item_id).cast("string").alias("item"),
                              plain_words(F.col(item_text)).alias("words"))
    item_marks = _winnowed(item_words, window, gram, "item")
    short = item_words.where(F.size("words").between(1, window - 1))
    # explode() of a column would push a filter on its size below, and with it copies of
    # all expressions that make it; explode_outer() doesn't.
    probes = (item_marks.select("item", "words", F.explode_outer("marks").alias("m")).where("m is not null")
              .select("item", "words", "m.*")
              .unionByName(short.select("item", "words", F.size("words").alias("len"),
                                        F.lit(0).alias("pos"),
                                        F.xxhash64(F.transform("words", lambda w: F.xxhash64(w)))
                                        .alias("hash"))))

    base = keyed(docs, doc_id, text)
    doc_words = base.select(ROW_ID, ROW_TEXT, plain_words(F.col("__text")).alias("words"))
    # At most window - 1 lengths, as one value of a scalar subquery.
    lengths = short.select(F.collect_set(F.size("words")).alias("lens")).scalar()
    marked = _winnowed(doc_words, window, gram, ROW_ID, ROW_TEXT)
    marked = marked.select("*", lengths.alias("lens"))
    whole = F.flatten(F.transform(
        F.filter("lens", lambda m: m <= F.size("hashes")),
        lambda m: F.transform(F.sequence(F.lit(0), F.size("hashes") - m), lambda i: F.struct(
            m.alias("len"), i.alias("pos"), _run("hashes", i, m).alias("hash")))))
    places = (marked.select(ROW_ID, ROW_TEXT, F.explode_outer(F.concat("marks", whole)).alias("m"))
              .where("m is not null")
              .select(ROW_ID, ROW_TEXT, "m.*"))
    met = places.join(probes.select("len", "hash").distinct(), ["len", "hash"], "left_semi")
    found = (met.groupBy(ROW_ID, ROW_TEXT)
             .agg(F.collect_set(F.struct("len", "pos", "hash")).alias("marks")))

    # The words around each common fingerprint, nearest first on the left.
    again = (join_small(base, stored(found, "marked-documents"), "inner")
             .select(ROW_ID, ROW_TEXT, plain_words(F.col("__text")).alias("words"), "marks"))
    doc_side = _around(again.select(ROW_ID, ROW_TEXT, "words", F.explode("marks").alias("m"))
                       .select(ROW_ID, ROW_TEXT, "words", "m.*"), gram, reach, ROW_ID, ROW_TEXT)
    item_side = _around(probes, gram, reach, "item").drop("pos")
    d, p = doc_side.alias("d"), item_side.alias("p")
    pairs = d.join(p, (F.col("d.len") == F.col("p.len")) & (F.col("d.hash") == F.col("p.hash"))
                   & (F.col("d.body") == F.col("p.body")))
    left, right = _common("left", reach), _common("right", reach)
    long_hit = (F.col("d.len") == 0) & (left + right + gram >= window)
    hits = (pairs.where((F.col("d.len") > 0) | long_hit)
            .select(f"d.{ROW_ID}", f"d.{ROW_TEXT}", "p.item",
                    F.when(F.col("d.len") > 0, F.struct(
                        F.col("d.pos").alias("start"), (F.col("d.pos") + F.col("d.len")).alias("end")))
                    .otherwise(F.struct((F.col("d.pos") - left).alias("start"),
                                        (F.col("d.pos") + gram + right).alias("end"))).alias("span")))
    per_doc = hits.groupBy(ROW_ID, ROW_TEXT).agg(
        F.array_sort(F.collect_set("item")).alias("item_ids"),
        F.collect_set("span").alias("raw"))
    places_hit = F.array_sort(F.array_distinct(F.flatten(
        F.transform("raw", lambda s: F.sequence(s["start"], s["end"] - 1)))))
    per_doc = per_doc.select(ROW_ID, ROW_TEXT, "item_ids", places_hit.alias("hit"))
    return per_doc.select(ROW_ID, ROW_TEXT, "item_ids", F.size("hit").cast("bigint").alias("n_hit"),
                          _runs("hit").alias("spans"))


def _judged(docs: DataFrame, items: DataFrame, doc_id: str, text: str, *params) -> DataFrame:
    per_doc = _hits(docs, items, doc_id, text, *params)
    base = keyed(docs, doc_id, text)
    counted = base.select(ROW_ID, ROW_TEXT,
                          F.size(plain_words(F.col("__text"))).cast("bigint").alias("n_words"))
    none = F.array()
    return join_rows(counted, per_doc, "left").select(
        ROW_ID, ROW_TEXT, "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("spans", none.cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("item_ids", none.cast("array<string>")).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def _around(rows: DataFrame, gram: int, reach: int, *keep: str) -> DataFrame:
    """Body of a fingerprint as words, and up to ``reach`` words left (nearest first) and
    right of it."""
    body_len = F.when(F.col("len") > 0, F.col("len")).otherwise(F.lit(gram))
    return rows.select(
        *keep, "len", "pos", "hash", F.slice("words", F.col("pos") + 1, body_len).alias("body"),
        F.transform(F.array(*[F.lit(o) for o in range(1, reach + 1)]),
                    lambda o: F.get("words", F.col("pos") - o)).alias("left"),
        F.transform(F.array(*[F.lit(o) for o in range(reach)]),
                    lambda o: F.get("words", F.col("pos") + gram + o)).alias("right"))


def _common(side: str, reach: int) -> Column:
    """How many words of ``side`` agree, counted from the body outwards."""
    out = F.lit(reach)
    for o in range(reach - 1, -1, -1):
        same = F.get(f"d.{side}", F.lit(o)) == F.get(f"p.{side}", F.lit(o))
        out = F.when(F.coalesce(same, F.lit(False)), out).otherwise(F.lit(o))
    return out


def _runs(places: str) -> Column:
    """Ranges of consecutive numbers in a sorted array of distinct ones."""
    starts = F.filter(places, lambda p, i: ~F.coalesce(F.get(places, i - 1) == p - 1, F.lit(False)))
    ends = F.filter(places, lambda p, i: ~F.coalesce(F.get(places, i + 1) == p + 1, F.lit(False)))
    return F.zip_with(starts, ends, lambda a, z: F.struct(a.alias("start"), (z + 1).alias("end")))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      **params) -> DataFrame:
    """The documents, all columns, without those that hold any item window. Null, empty and
    repeated texts, items and tables as in ``decontaminate``: null and empty texts stay, rows
    repeated with one id and text all stay or all go."""
    hit = _hits(docs, items, doc_id, text, **params).select(ROW_ID, ROW_TEXT)
    return drop_row_key(join_small(with_row_key(docs, doc_id, text), stored(hit, "contaminated"), "left_anti"))
