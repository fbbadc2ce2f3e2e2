import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from stationflow.llm import golay, simhash
from stationflow.llm.components import connected_components

from .conftest import LONG, by_id


def plain_fingerprint(text, k=3):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not w:
        return 0
    runs = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(ids, fps, bits=2):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return {ids[i]: min(groups[find(i)]) for i in range(len(ids))}


def test_golay_code_is_perfect_and_close_words_share_a_key():
    words = np.arange(1 << 23, step=37, dtype=np.int32)
    code = golay.decode(words)
    assert code.min() >= 0 and code.max() < 4096
    row, key = golay.keys(words[:3000])
    counts = np.bincount(row)
    assert set(counts.tolist()) <= {1, 6}
    of = {}
    for r, k in zip(row.tolist(), key.tolist()):
        of.setdefault(r, set()).add(k)
    r = random.Random(1)
    for i in range(3000):
        other = int(words[i]) ^ sum(1 << b for b in r.sample(range(23), r.randint(0, 2)))
        assert of[i] & set(golay.keys(np.array([other], np.int32))[1].tolist())


def test_fingerprints_and_components_match_brute_force(documents, prose):
    texts = prose(60, 0, 40)
    texts += [t.replace("the", "thx", 1) + " z" for t in texts[:30]] + texts[:20] + ["", None, " \n", "A b", "a\tB", LONG]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    got = by_id(simhash.simhash_components(documents(rows)))
    fps = [plain_fingerprint(t) for _, t in rows]
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for (i, _), f in zip(rows, fps)}
    assert {i: r.component_id for i, r in got.items()} == components([i for i, _ in rows], fps)


def test_links_of_crowded_and_of_small_buckets_connect_alike(spark):
    r = random.Random(2)
    fps = set()
    for _ in range(12):
        at = r.getrandbits(64)
        for _ in range(40):  # chains in steps of one to three bits
            fps.add(at)
            at ^= sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 2, 3])))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = components(signed, fps)
    frame = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    for limit in (64, 8, 1):
        found = connected_components(simhash.links(frame, pair_limit=limit))
        assert {n: r for n, r in found.collect()} == {n: c for n, c in want.items()
                                                     if list(want.values()).count(c) > 1}


def test_components_of_long_chains_and_no_links(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 101), (None, 3)]
    r = random.Random(4)
    r.shuffle(chain)
    found = {n: c for n, c in connected_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_dedup_keeps_one_row_of_each_group(documents):
    docs = documents([(4, "a b c d"), (2, "A b c d"), (None, "a b  c d"), (7, "other words here now"), (9, None), (8, "")])
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns and sorted(by_id(kept)) == [2, 7, 8]
    only_null = simhash.near_dedup(documents([(None, "x y z"), (None, "X y z")]))
    assert [r.text for r in only_null.collect()] in (["x y z"], ["X y z"])
    assert simhash.near_dedup(documents([])).count() == 0
    assert simhash.simhash_components(documents([])).count() == 0
    twice = documents([(1, "q r s"), (1, "q r s")])
    assert simhash.near_dedup(twice).count() == 1
    often = documents([(i, "unlike this one or that") for i in range(3)] + [(7, "a b c d e")] * 1000 + [(8, None)] * 9)
    kept = simhash.near_dedup(often)
    assert kept.columns == often.columns and sorted(r.doc_id for r in kept.collect()) == [0, 7, 8]
    assert simhash.fingerprints(twice).select(F.count_distinct("fp")).first()[0] == 1
