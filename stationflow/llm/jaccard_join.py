"""Similarity join of documents on the Jaccard overlap of word n-grams, by T-occurrence search.

A document is the set of hashes of its shingles. Two sets of sizes a and b that reach the
asked share p of their union have o >= p (a + b) / (1 + p) shingles in common, so at least
ceil(p a). A search for the partners of a set is therefore a T-occurrence query: of the
inverted lists of its shingles, find the documents that are in T of them or more.

DivideSkip answers it inside a block of documents: the L longest lists are set aside; the
short ones are merged by a heap that skips ahead where fewer than T - L lists can meet; what
they find is looked up in the long lists by binary search, up to the overlap needed.

Who has to be searched where is told by prefixes, without any list of pairs:

* Of every set only its smallest hashes (the head) are listed by hash. Sets in order of their
  hashes that share o of them share at least e of their first n - o + e. With e = 1 + n // 10,
  a head has n - ceil(p n) + e hashes, and a set with too few hashes in other heads has no
  partner. Of the rest, whole sets are listed, and a set needs ceil(p n) hashes that others
  have too. What is left are candidates, a small part of a corpus without copies.
* In order of frequency, rare hashes first, partners share one of their first n - ceil(p n) + 1.
  Those that others have as well are a candidate's keys.
* Candidates live in blocks by one of their keys. Blocks have a bounded number of hashes; a key
  that fills several blocks has its first document in each of them. Round one searches every
  block for its own documents, breadth first: what was found needn't be found again, so a
  thousand variants of one text cost a thousand look-ups and not a million.
* Round two searches across blocks. Classes found so far are known, and a document only looks
  for documents of larger classes, in blocks that hold one with a key of its own.

Equal sets are one set throughout. Shingles are told apart by 64-bit hashes, sets by 128 bits.
"""

from __future__ import annotations

import hashlib
import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW_ID, ROW_TEXT, join_rows, keyed, small_batches, stored
from .components import connected_components

EXTRA = 10  # a head has one more hash for so many shingles
BLOCK_HASHES = 1 << 20  # hashes of a block, about
OFTEN, BROADCAST_ROWS = 100_000, 1_000_000
HEAP_ENTRIES, PROBES = 1 << 11, 32  # beyond these, lists are merged and documents looked up by numpy
BLOCK_QUERIES = 1 << 12  # documents of other blocks that one task looks up
HOT_HASHES, TRACKED = 1000, 20_000  # hashes of heads that are listed apart, and counted to find them
LONG_LISTS = 0.0085  # the weight of a long list's length in DivideSkip's choice of L
_TURNS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


# --------------------------------------------------------------------------- sets

def shingle_set(text: str | None, shingle: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``shingle`` words (signed 64 bits); of all words
    together if there are fewer; none without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII rules, being bytes
    if not words:
        return np.zeros(0, np.int64)
    if len(words) < shingle:
        return np.array([xxh64_intdigest(b" ".join(words), len(words))], np.uint64).view(np.int64)
    each = np.array([xxh64_intdigest(w) for w in words], np.uint64)
    n = len(words) - shingle + 1
    runs = np.full(n, shingle, np.uint64)
    for i in range(shingle):
        runs ^= each[i:i + n] * _TURNS[0]
        runs = (runs << np.uint64(29) | runs >> np.uint64(35)) * _TURNS[1] + _TURNS[2]
    runs ^= runs >> np.uint64(32)
    return np.unique(runs.view(np.int64))


def least_overlap(n, percent: int):
    """The overlap that a set of ``n`` needs with any partner."""
    return (percent * n + 99) // 100


def pair_overlap(a: int, b, percent: int):
    """The overlap that makes sets of ``a`` and ``b`` partners."""
    return -(-percent * (a + b) // (100 + percent))


def shared_needed(n: int) -> int:
    """How many hashes the heads of partners share if the smaller one has ``n``."""
    return 1 + n // EXTRA


def head_length(n: int, percent: int) -> int:
    return min(n, n - least_overlap(n, percent) + shared_needed(n))


# --------------------------------------------------------------------------- search in a block

class InvertedLists:
    """For every hash the documents that have it, in ascending order."""

    def __init__(self, sets: list[np.ndarray], documents: np.ndarray):
        """``documents`` are indexes into ``sets``, ascending."""
        chosen = [sets[i] for i in documents]
        flat = np.concatenate(chosen) if chosen else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.owners = np.repeat(documents, [len(s) for s in chosen])[order]
        self.keys, self.starts = np.unique(flat[order], return_index=True)
        self.stops = np.append(self.starts[1:], len(flat))
        self.owner = self.owners.tolist()

    def of(self, hashes: np.ndarray) -> list[tuple[int, int]]:
        """(start, stop) of the lists of ``hashes`` that there are, the shortest first."""
        if not len(self.keys):
            return []
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        at = at[self.keys[at] == hashes]
        at = at[np.argsort(self.stops[at] - self.starts[at], kind="stable")]
        return list(zip(self.starts[at].tolist(), self.stops[at].tolist()))


def merge_skip(owner: list[int], lists: list[tuple[int, int]], least: int) -> Iterator[tuple[int, int]]:
    """(document, number of lists) of all that are in ``least`` of the lists or more."""
    heap = [(owner[a], i, a) for i, (a, z) in enumerate(lists) if a < z]
    heapq.heapify(heap)
    while len(heap) >= least:
        now, taken = heap[0][0], []
        while heap and heap[0][0] == now:
            taken.append(heapq.heappop(heap))
        if len(taken) >= least:
            yield now, len(taken)
            onward = [(i, a + 1) for _, i, a in taken]
        else:
            # With least - 1 lists taken, no document before the next top can be in enough.
            while heap and len(taken) < least - 1:
                taken.append(heapq.heappop(heap))
            if not heap:
                return
            top = heap[0][0]
            onward = [(i, bisect_left(owner, top, a, lists[i][1])) for _, i, a in taken]
        for i, a in onward:
            if a < lists[i][1]:
                heapq.heappush(heap, (owner[a], i, a))


def merged(index: InvertedLists, lists: list[tuple[int, int]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents in ``least`` of the lists or more, and in how many: by ``merge_skip``, or by a
    merge of all lists at once where they are long."""
    if sum(z - a for a, z in lists) > HEAP_ENTRIES:
        found, counts = np.unique(np.concatenate([index.owners[a:z] for a, z in lists]), return_counts=True)
        return found[counts >= least], counts[counts >= least]
    found = list(merge_skip(index.owner, lists, least))
    return np.array([d for d, _ in found], np.int64), np.array([c for _, c in found], np.int64)


def divide_skip(index: InvertedLists, hashes: np.ndarray, sizes: np.ndarray, percent: int, wanted: np.ndarray
                ) -> np.ndarray:
    """Documents of the index that are partners of a set, of those ``wanted`` (by index)."""
    n = len(hashes)
    least = least_overlap(n, percent)
    lists = index.of(hashes)
    if not n or len(lists) < least:
        return np.zeros(0, np.int64)
    longest = lists[-1][1] - lists[-1][0]
    aside = min(least - 1, int(least / (LONG_LISTS * np.log2(longest + 1) + 1)))
    short, long = lists[:len(lists) - aside], lists[len(lists) - aside:]
    found, counts = merged(index, short, least - aside)
    need = pair_overlap(n, sizes[found], percent) - counts
    open_ = wanted[found] & (need <= aside)
    found, need = found[open_], need[open_]
    if len(found) <= PROBES:
        owner = index.owner
        for i, document in enumerate(found.tolist()):
            missing = int(need[i])
            for left, (a, z) in zip(range(aside, 0, -1), long):
                if missing <= 0 or missing > left:
                    break
                at = bisect_left(owner, document, a, z)
                missing -= at < z and owner[at] == document
            need[i] = missing
        return found[need <= 0]
    for left, (a, z) in zip(range(aside, 0, -1), long):
        part = index.owners[a:z]
        need = need - (part[np.minimum(np.searchsorted(part, found), z - a - 1)] == found)
        if left % 16 == 0:  # now and then, drop those that can't reach it
            found, need = found[need < left], need[need < left]
    return found[need <= 0]


def block_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all partners within a block: breadth first, each document is looked
    up once, in lists of those that no search has found yet."""
    sizes, free = np.array([len(s) for s in sets], np.int64), np.ones(len(sets), bool)
    index, listed = InvertedLists(sets, np.arange(len(sets))), len(sets)
    left, links = len(sets), []
    for first in range(len(sets)):
        if not free[first]:
            continue
        free[first] = False
        left -= 1
        queue = [first]
        while queue:
            now = queue.pop()
            if 4 * left < 3 * listed:  # a quarter of the listed are found: list the others anew
                index, listed = InvertedLists(sets, np.flatnonzero(free)), left
            found = divide_skip(index, sets[now], sizes, percent, free).tolist()
            free[found] = False
            left -= len(found)
            links += [(now, other) for other in found]
            queue += found
    return links


# --------------------------------------------------------------------------- distribution

def _sets(rows: DataFrame, shingle: int, percent: int, full: bool) -> DataFrame:
    """The columns of ``rows`` but the text, with ``n``, and the whole set as ``hashes`` or its
    ``digest``, ``set`` (64 bits of it) and ``head``."""
    keep = [f for f in rows.schema if f.name != "__text"]
    names = [f.name for f in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    schema += ", n bigint, " + ("hashes array<bigint>" if full else "digest binary, `set` bigint, head array<bigint>")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [shingle_set(t, shingle) for t in pdf["__text"]]
            out = pdf[names].assign(n=np.array([len(s) for s in found], np.int64))
            if full:
                yield out.assign(hashes=found)
                continue
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in found]
            yield out.assign(digest=digests, set=[int.from_bytes(d[:8], "little", signed=True) for d in digests],
                             head=[s[:head_length(len(s), percent)] for s in found])

    small_batches(rows.sparkSession)
    return rows.mapInPandas(run, schema)


def _shared_heads(rows: DataFrame) -> DataFrame:
    """(set, shared): how many hashes of a set's head other heads have too. The most frequent
    hashes are found by a sketch and treated apart: of them only the least and the greatest set
    are gathered, so that no task holds the sets of one of them."""
    none = F.array().cast("array<bigint>")
    top = rows.select(F.explode("head").alias("h")).agg(F.expr(f"approx_top_k(h, {HOT_HASHES}, {TRACKED})").alias("top"))
    found = stored(top.select(F.col("top.item").alias("hot")), "hot-hashes")
    hot = F.coalesce(found.scalar(), none)
    numbers = np.array(sorted(found.first().hot or []), np.int64)  # HOT_HASHES at most

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least = np.full(len(numbers), np.iinfo(np.int64).max)
        most = np.full(len(numbers), np.iinfo(np.int64).min)
        for pdf in batches:
            flat = np.concatenate([np.zeros(0, np.int64), *pdf["head"]])
            owner = np.repeat(pdf["set"].to_numpy(np.int64), [len(x) for x in pdf["head"]])
            at = np.searchsorted(numbers, flat)
            hit = numbers[np.minimum(at, len(numbers) - 1)] == flat if len(numbers) else np.zeros(len(flat), bool)
            np.minimum.at(least, at[hit], owner[hit])
            np.maximum.at(most, at[hit], owner[hit])
        met = least <= most
        yield pd.DataFrame({"h": numbers[met], "a": least[met], "z": most[met]})

    spread = (rows.select("set", "head").mapInPandas(ends, "h bigint, a bigint, z bigint")
              .groupBy("h").agg(F.min("a").alias("a"), F.max("z").alias("z")).where("a <> z"))
    spread = F.coalesce(stored(spread.agg(F.collect_list("h").alias("hot")), "hot-shared").scalar(), none)
    frequent = rows.groupBy("set").agg(F.max(F.size(F.array_intersect("head", spread))).alias("frequent"))
    lists = (rows.select("set", F.explode(F.array_except("head", hot)).alias("h")).repartition("h").groupBy("h")
             .agg(F.collect_set("set").alias("sets")).where(F.size("sets") > 1))
    rare = lists.select(F.explode("sets").alias("set")).groupBy("set").agg(F.count(F.lit(1)).alias("rare"))
    return frequent.join(rare, "set", "left").select(
        "set", (F.col("frequent") + F.coalesce("rare", F.lit(0))).alias("shared"))


def _needed(n: Column, percent: int) -> Column:
    """``shared_needed`` of the smallest partner that a set of ``n`` can have."""
    return F.floor(_least(n, percent) / EXTRA) + 1


def _least(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100)


def _keys(sets: DataFrame, percent: int) -> DataFrame:
    """(sid, n, keys) of the sets that have enough hashes in common with others: those of the
    rarest that one of them must be shared with any partner."""
    each = sets.select("sid", F.explode("hashes").alias("h"))
    common = stored(each.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "common-hashes")
    # Hashes that make up more than a share of 1 / OFTEN of all are fewer than OFTEN: they are
    # broadcast, so that no task joins all rows of one.
    total = sets.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]
    often = F.col("df") * OFTEN > total
    hot = F.broadcast(common.where(often))
    met = (each.join(hot, "h")
           .unionByName(each.join(F.broadcast(common.where(often).select("h")), "h", "left_anti")
                        .join(common.where(~often), "h")))
    of = met.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("met"))
    n, m = F.col("n"), F.size("met")
    strong = sets.select("sid", F.size("hashes").cast("bigint").alias("n")).join(of, "sid").where(m >= _least(n, percent))
    return strong.select("sid", "n", F.slice("met", F.lit(1), (m - _least(n, percent) + 1).cast("int"))
                         .getField("h").alias("keys"))


def _blocks(candidates: DataFrame) -> DataFrame:
    """(block, sid): each candidate in the block of one of its keys, and the first candidate of
    a key in every block that this key fills."""
    total = candidates.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    count = max(1, -(-total // BLOCK_HASHES))
    home = candidates.select("sid", "n", F.array_min("keys").alias("home"))
    homes = home.groupBy("home").agg(F.ceil(F.sum("n") * 2 / BLOCK_HASHES).alias("parts"), F.min("sid").alias("first"))

    def block(part: Column) -> Column:
        return F.pmod(F.xxhash64("home", part), F.lit(count)).alias("block")

    wide = homes.where("parts > 1")
    part = F.pmod(F.xxhash64("sid"), F.coalesce("parts", F.lit(1)))
    own = home.join(wide, "home", "left").select(block(part.cast("bigint")), "sid")
    firsts = wide.select("home", "first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("p"))
    return own.unionByName(firsts.select(block(F.col("p")), F.col("first").alias("sid"))).distinct()


def _within(members: DataFrame, percent: int) -> DataFrame:
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        sids = pdf["sid"].to_numpy(np.int64)
        links = np.array(block_links(pdf["hashes"].tolist(), percent), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": sids[links[:, 0]], "b": sids[links[:, 1]]})

    return members.groupBy("block").applyInPandas(search, "a bigint, b bigint")


def _across(candidates: DataFrame, blocks: DataFrame, sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links to documents of larger classes in other blocks."""
    rank = F.struct("size", "class")
    known = candidates.join(classes, "sid").select("sid", rank.alias("rank"), F.explode("keys").alias("h"))
    listed = known.join(blocks, "sid").groupBy("h", "block").agg(F.max("rank").alias("most"))
    routes = known.join(listed, "h").where(F.col("most") > F.col("rank")).select("block", "sid", "rank").distinct()
    routes = stored(routes, "block-queries")
    parts = routes.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).alias("parts"))
    part = F.pmod(F.xxhash64("sid"), F.col("parts")).alias("part")
    asking = (routes.join(parts, "block").select("block", part, "sid", "rank").join(sets, "sid")
              .select("block", "part", F.col("sid").alias("asking"), "rank.*", F.col("hashes").alias("asked")))
    held = (blocks.join(classes, "sid").join(parts, "block").join(sets, "sid")
            .select("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
                    F.col("sid").alias("sid"), F.col("size").alias("size"), F.col("class").alias("class"),
                    F.col("hashes").alias("hashes")))

    def search(queries: pd.DataFrame, documents: pd.DataFrame) -> pd.DataFrame:
        sets_held = documents["hashes"].tolist()
        sizes = np.array([len(s) for s in sets_held], np.int64)
        index = InvertedLists(sets_held, np.arange(len(sets_held)))
        sids, found = documents["sid"].tolist(), []
        size, kind = documents["size"].to_numpy(), documents["class"].to_numpy()
        for sid, own, of, hashes in zip(queries["asking"], queries["size"], queries["class"], queries["asked"]):
            larger = (size > own) | ((size == own) & (kind > of))
            met = {kind[i]: sids[i] for i in divide_skip(index, hashes, sizes, percent, larger)}  # one of each class
            found += [(sid, other) for other in met.values()]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return (asking.groupBy("block", "part").cogroup(held.groupBy("block", "part"))
            .applyInPandas(search, "a bigint, b bigint"))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5,
                       percent: int = 80) -> DataFrame:
    """One row per document row: id, ``n_shingles`` (distinct) and ``component_id``.

    Words are runs of characters other than blanks, A-Z lower-cased; shingles are ``shingle``
    consecutive words, or all words if there are fewer. Documents link when their sets share
    ``percent`` of 100 of their union or more; ``component_id`` is the smallest id that links
    reach, null ids aside (null if there are no others). A null, empty or blank text has an
    empty set and links with nothing, so its component is its own id. Repeated rows are equal
    sets. An empty table gives no rows. Other columns are not read."""
    base = keyed(docs, doc_id, text)
    rows = stored(_sets(base, shingle, percent, full=False), "shingle-heads")
    first = F.min(F.struct(F.col(ROW_ID).isNull().alias("no_id"), ROW_ID, ROW_TEXT)).alias("least")
    groups = rows.where("n > 0").groupBy("digest").agg(first, F.max("n").alias("n"), F.max("set").alias("set"),
                                                       F.count(F.lit(1)).alias("rows"))
    groups = stored(groups, "equal-sets")
    chosen = groups.join(_shared_heads(rows), "set").where(F.col("shared") >= _needed(F.col("n"), percent))
    chosen = stored(chosen.select(F.monotonically_increasing_id().alias("sid"), "digest", "least"), "chosen-sets")
    wanted = chosen.select(f"least.{ROW_ID}", f"least.{ROW_TEXT}", "sid")
    count = chosen.count()
    if count <= BROADCAST_ROWS:  # three numbers a row; beyond that, texts are shuffled to the keys
        wanted = F.broadcast(wanted)
    again = join_rows(base, wanted, "inner").select("sid", "__text")
    sets = stored(_sets(again, shingle, percent, full=True).select("sid", "hashes"), "sets")
    if sets.count() > count:  # rows repeated with one id and text
        sets = stored(sets.groupBy("sid").agg(F.any_value("hashes").alias("hashes")), "sets-once")
    candidates = stored(_keys(sets, percent), "candidates")
    blocks = stored(_blocks(candidates), "blocks")
    inside = stored(_within(blocks.join(sets, "sid"), percent), "links-inside")

    roots = connected_components(inside)
    named = candidates.select("sid").join(roots.withColumnRenamed("node", "sid"), "sid", "left") \
        .select("sid", F.coalesce("root", "sid").alias("class"))
    sizes = named.groupBy("class").agg(F.count(F.lit(1)).alias("size"))
    classes = stored(named.join(sizes, "class"), "classes")
    across = _across(candidates, blocks, sets, classes, percent)
    links = inside.unionByName(across)

    roots = connected_components(links)
    linked = (chosen.join(roots.withColumnRenamed("node", "sid"), "sid")
              .select("digest", "least", "root"))
    least = linked.groupBy("root").agg(F.min("least").alias("least"))
    named = stored(linked.drop("least").join(least, "root").select("digest", F.col("least").alias("of")), "named-sets")
    groups = groups.join(named, "digest", "left").select(
        "digest", "rows", F.coalesce(f"of.{ROW_ID}", f"least.{ROW_ID}").alias("component_id"))
    return _named(rows, groups, doc_id)


def _named(rows: DataFrame, groups: DataFrame, doc_id: str) -> DataFrame:
    """Every row with the component of its set. Sets of more than a thousandth of all rows are
    fewer than a thousand and are broadcast, so that no task joins all rows of one set."""
    total = groups.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    many = F.col("rows") * 1000 > total
    narrow = rows.select(F.col(ROW_ID).alias("id"), "n", "digest")
    filled, empty = narrow.where("n > 0"), narrow.where("n = 0")
    hot = F.broadcast(groups.where(many).drop("rows"))
    out = [F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id"]
    return (filled.join(hot, "digest").select(*out)
            .unionByName(filled.join(hot.select("digest"), "digest", "left_anti")
                         .join(groups.where(~many).drop("rows"), "digest").select(*out))
            .unionByName(empty.withColumn("component_id", F.col("id")).select(*out)))
