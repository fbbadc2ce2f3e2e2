import hashlib
import random
import zlib

import pytest

from stationflow.llm import prefix_trie as P

SCHEMA = "conv_id bigint, turn bigint, role string, text string, ids int, words int, path string, code int, id int"


def frame(spark, turns):
    return spark.createDataFrame([(*t, 1, 2, "clash", 3, 4) for t in turns], SCHEMA)


def plain_nodes(paths):
    """paths: conv -> tuple of (role, text)."""
    members = {}
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(conv)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        below = [out[c] for c in children.get(p, [])]
        own = (len(members[p]) - 1) * len(p[-1][1].encode().split()) if p else 0
        ends = ",".join(map(str, sorted(c for c in members[p] if paths[c] == p)))
        out[p] = (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below),
                  sum(b[5] for b in below) or 1, own + sum(b[6] for b in below),
                  hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def plain_paths(turns, every=None):
    own = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: tuple((r, x) for _, _, r, x in sorted(t)) for c, t in own.items()}
    if not every:
        return own
    out = {}
    for c, path in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % every, ())[:h] + path[h:]
    return out


def nodes(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens", "ends_sha256").collect()), key=str)


@pytest.fixture
def turns():
    r = random.Random(3)
    texts = ["", None, "hello there", "  how are\tyou ", "é x", "long " * 40] + [f"t{i} w" for i in range(8)]
    out = []
    for conv in range(160):
        if conv % 20 == 0 and r.random() < 0.2:
            continue
        path = [(r.choice(["user", "assistant", None]), r.choice(texts[:4 + conv % 9])) for _ in range(r.randint(1, 7))]
        if r.random() < 0.4:
            path = [("system", "be brief"), ("user", "hello there"), ("assistant", "x y z")][:r.randint(1, 3)]
        out += [(conv * 7 % 1009, None if not i and r.random() < 0.2 else i, *p) for i, p in enumerate(path)]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("shard", [1_000_000, 60, 7])
def test_trie_equals_brute_force(spark, turns, shard, monkeypatch):
    monkeypatch.setattr(P, "PIECE_IDS", 3)
    got = P.prefix_trie(P.paths(frame(spark, turns)), shard_turns=shard)
    assert nodes(got) == plain_nodes(plain_paths(turns))


@pytest.mark.parametrize("shard", [1_000_000, 25])
def test_rebuilt_trie_equals_brute_force(spark, turns, shard):
    got = P.prefix_trie(P.rebuilt_paths(frame(spark, turns), every=20, turns=4), shard_turns=shard)
    assert nodes(got) == plain_nodes(plain_paths(turns, every=20))


def test_one_conversation_in_a_third_of_all(spark):
    turns = [(c, t, "user", f"turn {t}") for c in range(90) for t in range(3)]
    turns += [(c, t, "user", f"own {c} {t}") for c in range(90, 270) for t in range(3)]
    got = P.prefix_trie(P.paths(frame(spark, turns)), shard_turns=40)
    assert nodes(got) == plain_nodes(plain_paths(turns))


def test_nulls_ties_repeats_and_empty_tables(spark):
    odd = [(1, None, None, None), (1, 0, "user", "a b"), (2, 0, None, ""), (2, 1, "user", "a b"), (None, 0, "user", "x"),
           (3, None, "", "")]
    assert nodes(P.prefix_trie(P.paths(frame(spark, odd)))) == plain_nodes(plain_paths(odd))
    tied = [(1, 0, "user", "a"), (1, 0, "user", "b"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    got = nodes(P.prefix_trie(P.paths(frame(spark, tied))))
    assert max(r[1] for r in got) == 3 and got == nodes(P.prefix_trie(P.paths(frame(spark, tied[::-1]))))
    assert P.prefix_trie(P.paths(frame(spark, []))).count() == 0
    assert P.prefix_trie(P.rebuilt_paths(frame(spark, []), 20, 4)).count() == 0


def test_a_conversation_without_turns_is_in_the_root_only(spark):
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in range(1, 20)}
    c = next(c for c in h if h[c] == 3)
    turns = [(c, 0, "user", "x"), (c, 1, "user", "y")]  # all turns are left out, and there is no conversation 0
    got = nodes(P.prefix_trie(P.rebuilt_paths(frame(spark, turns), 20, 4)))
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_search_tree_is_balanced_and_finds_all():
    order = list(P.medians(1023))
    assert sorted(order) == list(range(1023)) and order[0] == 511
    tree = P.SearchTree()
    at = {i: tree.insert([i, 5], [1, 1]) for i in order}
    for i, node in at.items():
        assert list(tree.walk([i, 5]))[-1] == node
    depth, todo = 0, [(tree.down[0], 1)]
    while todo:
        n, d = todo.pop()
        if n >= 0:
            depth = max(depth, d)
            todo += (tree.low[n], d + 1), (tree.high[n], d + 1)
    assert depth == 10
    assert sorted(tree.in_order()) == list(range(len(tree.key)))
