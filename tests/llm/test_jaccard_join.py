import random

import numpy as np
import pytest

from stationflow.llm import jaccard_join as J

from .conftest import LONG, by_id


def plain_set(text, k=5):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def plain_components(rows, percent=80):
    ids, sets = [i for i, _ in rows], [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(ids[i])
    return {i: (len(s), min(groups[find(n)])) for n, (i, s) in enumerate(zip(ids, sets))}


def variants(r, text, n, edits):
    """Copies with some words changed, so that neighbours in a chain are alike, ends may not be."""
    out = []
    for _ in range(n):
        words = text.split()
        for _ in range(r.randint(1, edits)):
            words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
        out.append(" ".join(words))
        text = out[-1] if r.random() < 0.5 else text
    return out


@pytest.fixture
def corpus(prose):
    r = random.Random(8)
    texts = prose(120, 1, 60)
    common = " ".join(prose(1, 40, 40))
    texts += [common + " " + t for t in prose(25, 4, 14)] + [common] * 4  # a shared passage, near the threshold
    for t in prose(6, 60, 150):
        texts += [t] + variants(r, t, r.randint(3, 30), 3)
    for t in prose(3, 8, 12):
        texts += [t, t.upper(), t + " end", "start " + t]
    texts += ["", None, " \n\t", "one", "ONE", "one two", "a b c d", "a b c d e", "a b c d e f", LONG, LONG + "tail"]
    r.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


def test_components_equal_brute_force(documents, corpus):
    got = by_id(J.jaccard_components(documents(corpus)))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == plain_components(corpus)


def test_small_blocks_hot_hashes_and_split_queries_change_nothing(documents, corpus, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_HASHES", 700)
    monkeypatch.setattr(J, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(J, "HOT_HASHES", 5)
    monkeypatch.setattr(J, "OFTEN", 50)
    monkeypatch.setattr(J, "BROADCAST_ROWS", 0)
    got = by_id(J.jaccard_components(documents(corpus)))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == plain_components(corpus)


@pytest.mark.parametrize("entries, probes", [(1 << 11, 32), (0, 0), (1 << 30, 1 << 30)])
def test_divide_skip_finds_all_partners(monkeypatch, entries, probes):
    monkeypatch.setattr(J, "HEAP_ENTRIES", entries)
    monkeypatch.setattr(J, "PROBES", probes)
    r = np.random.default_rng(3)
    sets = []
    for _ in range(30):
        base = r.integers(0, 10**6, 60)
        for _ in range(r.integers(1, 8)):
            own = base.copy()
            own[r.integers(0, 60, r.integers(0, 16))] = r.integers(0, 10**6)
            sets.append(np.unique(np.concatenate([own, np.arange(8)])))  # eight hashes in all sets
    index, sizes = J.InvertedLists(sets, np.arange(len(sets))), np.array([len(s) for s in sets])
    for percent in (50, 80, 95, 100):
        for i, own in enumerate(sets):
            want = [j for j, s in enumerate(sets)
                    if 100 * len(np.intersect1d(own, s)) >= percent * len(np.union1d(own, s))]
            assert sorted(J.divide_skip(index, own, sizes, percent, np.ones(len(sets), bool))) == want
            found = J.divide_skip(index, own, sizes, percent, np.arange(len(sets)) != i)
            assert sorted(found) == [j for j in want if j != i]


def test_merge_skip_counts_lists():
    r = random.Random(4)
    for _ in range(60):
        lists = [sorted(r.sample(range(40), r.randint(0, 20))) for _ in range(r.randint(1, 9))]
        owner, cuts = [], []
        for x in lists:
            cuts.append((len(owner), len(owner) + len(x)))
            owner += x
        least = r.randint(1, len(lists))
        want = {d: n for d in range(40) if (n := sum(d in x for x in lists)) >= least}
        assert dict(J.merge_skip(owner, cuts, least)) == want


def test_a_third_of_all_rows_alike(documents, prose):
    r = random.Random(6)
    text = prose(1, 90, 90)[0]
    rows = [text] * 100 + variants(r, text, 100, 2) + prose(100, 20, 60)
    rows = list(enumerate(rows))
    got = by_id(J.jaccard_components(documents(rows)))
    assert {i: (x.n_shingles, x.component_id) for i, x in got.items()} == plain_components(rows)


def test_nulls_repeats_and_empty_tables(documents):
    text = "one two three four five six seven"
    rows = [(None, text), (5, text), (5, text), (9, text.upper()), (None, None), (7, None), (7, ""), (None, "x y")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id)
                  for r in J.jaccard_components(documents(rows)).collect()), key=str)
    assert got == sorted([(None, 3, 5), (5, 3, 5), (5, 3, 5), (9, 3, 5), (None, 0, None), (7, 0, 7), (7, 0, 7),
                          (None, 1, None)], key=str)
    assert J.jaccard_components(documents([])).count() == 0
    assert J.jaccard_components(documents([(1, None)])).collect() == [(1, 0, 1)]
