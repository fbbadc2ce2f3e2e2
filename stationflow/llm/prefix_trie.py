"""Prefix trie of conversations: ternary search trees by range shard, merged at their edges.

Turns are dictionary-encoded: every distinct (role, text) has one number, so a conversation
is a path of numbers. Paths are sorted and cut into range shards of a bounded number of
turns; equal paths are cut by conversation id, so a conversation that a third of all share
fills several shards like any other.

Each shard builds a ternary search tree: a node has a turn, a smaller and a larger sibling and
the root of its children. Distinct paths go in by median insertion, the middle one first,
then the middles of both halves, which balances the siblings. An iterative traversal, parents
before children, is then run backwards to add up members, leaves and savings.

Only prefixes of a shard's first and last path can occur in another shard. These boundary
nodes (twice the depth of a shard, at most) are merged by path; what hangs below them inside
a shard is final already. Their totals go up the short tree of boundary nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blank_words, small_batches, stored

SHARD_TURNS = 100_000  # turns and conversations of a range shard, about
PIECE_IDS = 20_000  # ids in a piece of a list that shards share
HOT_SHARE = 1000  # turns of more than a thousandth of all: fewer than a thousand


def paths(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """One row per conversation id: ``conv_id``, ``ids`` (numbers of its turns, in order) and
    ``words`` (of their texts).

    Turns are equal when role and text are (by SHA-256); null ones count as empty. Turns are
    ordered by ``turn``, null first, and by a hash of their content where it is equal; repeated
    rows are turns of their own. Rows without an id belong to no conversation. One row holds a
    conversation: 16 bytes a turn. An empty table gives no rows."""
    who, what = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    code = F.unhex(F.sha2(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, what), 256))
    turns = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), code.alias("code"),
        F.size(blank_words(what)).cast("bigint").alias("n_words"))
    turns = stored(turns, "turns")
    entries = turns.groupBy("code").agg(F.min("n_words").alias("n_words"), F.count(F.lit(1)).alias("n"))
    entries = stored(entries.select("code", "n_words", "n", F.monotonically_increasing_id().alias("id")), "dictionary")
    # Turns above a thousandth of all rows are fewer than a thousand: their entries are
    # broadcast, so that no task joins all rows of one turn.
    total = turns.count()
    common = F.col("n") * HOT_SHARE > total
    left = turns.select("conv_id", "turn", "code")
    hot = left.join(F.broadcast(entries.where(common).drop("n")), "code")
    rest = (left.join(F.broadcast(entries.where(common).select("code")), "code", "left_anti")
            .join(entries.where(~common).drop("n"), "code"))
    step = F.struct(F.col("turn").isNotNull(), "turn", F.xxhash64("code"), "id", "n_words")
    rows = hot.unionByName(rest).select("conv_id", step.alias("step")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("step")).alias("steps"))
    return rows.select("conv_id", F.col("steps.id").alias("ids"), F.col("steps.n_words").alias("words"))


def rebuilt_paths(conversations: DataFrame, every: int, turns: int, conv_id: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """``paths`` with conversations that share beginnings: each starts with the first h turns of
    the conversation whose id is its own less the remainder by ``every`` (all of them if it has
    fewer, none if there is no such conversation) and goes on with its own turns after the first
    h, if it has any. h is the crc32 of the id as text modulo ``turns``. Nulls, ties, repeated
    rows and empty tables as in ``paths``."""
    own = stored(paths(conversations, conv_id, turn, role, text), "paths")
    first = own.where(F.pmod("conv_id", F.lit(every)) == 0).select(
        F.col("conv_id").alias("start"), F.slice("ids", 1, turns).alias("start_ids"),
        F.slice("words", 1, turns).alias("start_words"))
    own = own.withColumn("start", F.col("conv_id") - F.pmod("conv_id", F.lit(every)))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(turns)).cast("int")
    empty = F.array().cast("array<bigint>")

    def rebuilt(c: str):
        return F.concat(F.slice(F.coalesce(f"start_{c}", empty), F.lit(1), h),
                        F.slice(F.col(c), h + 1, F.size(c))).alias(c)

    return own.join(first, "start", "left").select("conv_id", rebuilt("ids"), rebuilt("words"))


class SearchTree:
    """Ternary search tree over sequences. Node 0 is the empty sequence."""

    def __init__(self) -> None:
        self.key, self.low, self.high, self.down = [0], [-1], [-1], [-1]
        self.up, self.depth, self.words = [-1], [0], [0]

    def _new(self, key: int, up: int, words: int) -> int:
        self.key.append(key)
        self.words.append(words)
        self.up.append(up)
        self.depth.append(self.depth[up] + 1)
        for links in (self.low, self.high, self.down):
            links.append(-1)
        return len(self.key) - 1

    def insert(self, path: list[int], words: list[int]) -> int:
        """The node of the whole sequence; nodes that are missing on the way are made."""
        node = 0
        for key, n in zip(path, words):
            links, of = self.down, node
            while (at := links[of]) >= 0 and self.key[at] != key:
                links, of = (self.low if key < self.key[at] else self.high), at
            if at < 0:
                at = links[of] = self._new(key, node, n)
            node = at
        return node

    def walk(self, path: list[int]) -> Iterator[int]:
        """The nodes of all beginnings of a sequence that is in the tree."""
        node = 0
        yield node
        for key in path:
            node = self.down[node]
            while self.key[node] != key:
                node = self.low[node] if key < self.key[node] else self.high[node]
            yield node

    def in_order(self) -> list[int]:
        """All nodes, parents before their children."""
        out, todo = [0], [self.down[0]]
        while todo:
            at = todo.pop()
            if at >= 0:
                out.append(at)
                todo += self.high[at], self.down[at], self.low[at]
        return out


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of both halves."""
    todo = [(0, n)]
    while todo:
        a, z = todo.pop()
        if a < z:
            mid = (a + z) // 2
            yield mid
            todo += (mid + 1, z), (a, mid)


SHARD_SCHEMA = ("shard int, kind string, path array<bigint>, depth bigint, conv_id bigint, parent_conv_id bigint, "
                "n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, n_words bigint, ends string")


def shard_rows(shard: int, ids: list[list[int]], words: list[list[int]], convs: list[int]) -> list[tuple]:
    """Rows of one sorted shard, as in SHARD_SCHEMA: ``inner`` nodes are final but for the
    parent, if that is a boundary node (its path is given then); ``edge`` nodes have the totals
    of the inner nodes below them; ``ends`` are pieces of the list of ids that end there."""
    starts = [i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]]
    stops = [*starts[1:], len(ids)]
    tree, ends = SearchTree(), {}
    for i in medians(len(starts)):
        ends[tree.insert(ids[starts[i]], words[starts[i]])] = convs[starts[i]:stops[i]]
    edge = {**dict(zip(tree.walk(ids[0]), range(len(ids[0]) + 1)))}
    path_of = {n: ids[0][:d] for n, d in edge.items()} | {n: ids[-1][:d] for d, n in enumerate(tree.walk(ids[-1]))}
    size = len(tree.key)
    members, least = [0] * size, [None] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for node, found in ends.items():
        members[node], least[node] = len(found), found[0]
    order = tree.in_order()
    for node in reversed(order):
        up = tree.up[node]
        if node not in path_of:
            leaves[node] += children[node] == 0
            saved[node] += (members[node] - 1) * tree.words[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
        if up >= 0:
            members[up] += members[node]
            if least[up] is None or least[node] < least[up]:
                least[up] = least[node]
    out = []
    for node in order:
        up, found = tree.up[node], ends.get(node, [])
        common = (tree.depth[node], least[node])
        totals = (members[node], children[node], leaves[node], saved[node], tree.words[node])
        if node in path_of:
            out.append((shard, "edge", path_of[node], *common, None, *totals, None))
            for a in range(0, len(found), PIECE_IDS):
                piece = found[a:a + PIECE_IDS]
                out.append((shard, "ends", path_of[node], tree.depth[node], piece[0], *[None] * 6,
                            ",".join(map(str, piece))))
        else:
            digest = hashlib.sha256(",".join(map(str, found)).encode()).hexdigest()
            by_edge = up in path_of
            out.append((shard, "inner", path_of[up] if by_edge else None, *common, None if by_edge else least[up],
                        *totals, digest))
    return out


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    ids, words, convs = [], [], []
    for pdf in batches:
        ids += [x.tolist() for x in pdf["ids"]]
        words += [x.tolist() for x in pdf["words"]]
        convs += pdf["conv_id"].tolist()
    if ids:
        rows = shard_rows(TaskContext.get().partitionId(), ids, words, convs)
        columns = [c.split()[0] for c in SHARD_SCHEMA.split(", ")]
        for a in range(0, len(rows), 10_000):
            part = pd.DataFrame(rows[a:a + 10_000], columns=columns)
            for c in ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "n_words"):
                part[c] = part[c].astype("Int64")
            yield part


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each list from its pieces, which come in order, one batch at a time."""
    now, digest = None, hashlib.sha256()
    for pdf in batches:
        for path, piece in zip(pdf["path"], pdf["ends"]):
            path = path.tolist()
            if path != now:
                if now is not None:
                    yield pd.DataFrame({"path": [now], "ends_sha256": [digest.hexdigest()]})
                now, digest = path, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
    if now is not None:
        yield pd.DataFrame({"path": [now], "ends_sha256": [digest.hexdigest()]})


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie over ``conversations`` (``conv_id``, ``ids``, ``words``; see
    ``paths``): ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs`` (members), ``n_children``, ``n_leaves`` (nodes without children in its subtree,
    itself included), ``saved_tokens`` (over its subtree: members but one, times the words of
    the last turn) and ``ends_sha256`` (of the ids that end there, ascending, joined by commas).
    A node is known by ``conv_id`` and ``depth``. An empty table gives no rows."""
    rows = stored(conversations.select("conv_id", "ids", "words"), "trie-paths")
    small_batches(rows.sparkSession)
    size = rows.agg(F.coalesce(F.sum(F.size("ids") + 1), F.lit(0))).first()[0]
    shards = max(1, -(-size // shard_turns))
    ordered = rows.repartitionByRange(shards, "ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    parts = stored(ordered.mapInPandas(_shards, SHARD_SCHEMA), "trie-shards")

    partial = parts.where("kind = 'edge'")
    above = F.slice("path", 1, F.size("path") - 1)
    edge = stored(partial.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.max("n_words").alias("n_words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]), "trie-edges")
    below = edge.where(F.size("path") > 0).groupBy(above.alias("path")).agg(F.count(F.lit(1)).alias("more"))
    edge = edge.join(below, "path", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    own = edge.select(
        F.explode(F.transform(F.sequence(F.lit(0), F.size("path")), lambda d: F.slice("path", F.lit(1), d))).alias("path"),
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("int")).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"))
    totals = own.groupBy("path").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    parents = edge.select(F.col("path").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    pieces = (parts.where("kind = 'ends'").select("path", "conv_id", "ends").repartition("path")
              .sortWithinPartitions("path", "conv_id"))
    ends = pieces.select("path", "ends").mapInPandas(_digests, "path array<bigint>, ends_sha256 string")
    none = F.sha2(F.lit(""), 256)
    edges = (edge.drop("n_leaves", "saved")
             .withColumn("above", F.when(F.size("path") > 0, above))
             .join(totals, "path").join(parents, "above", "left").join(ends, "path", "left")
             .select("conv_id", F.size("path").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                     "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")))

    inner = parts.where("kind = 'inner'")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
               F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    # By shard and path, so that one task meets no more than the nodes of a shard.
    merged = partial.select("shard", "path").join(
        edge.select("path", F.col("conv_id").alias("parent_conv_id")), "path")
    hung = inner.where("path is not null").drop("parent_conv_id").join(merged, ["shard", "path"])
    return (inner.where("path is null").select(*columns).unionByName(hung.select(*columns)).unionByName(edges))
