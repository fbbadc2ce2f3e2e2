import hashlib
import re

from stationflow.llm.exact_dedup import exact_dedup

from .conftest import LONG


def brute(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t in rows}
    size = {i: len(t or "") for i, t in rows}
    out = {}
    for i, _ in rows:
        group = [j for j, _ in rows if norm[j] == norm[i]]
        keep = min(group, key=lambda j: (-size[j], j))
        out[i] = (keep, len(group), keep == i, hashlib.sha256(norm[i].encode()).hexdigest())
    return out


def test_matches_brute_force(documents, prose):
    texts = prose(40)
    rows = list(enumerate(texts + [t.replace(" ", " \t") for t in texts[:10]] + texts[:15] * 3
                          + ["", None, " \n", "é x", "éx", LONG, LONG + " "]))
    got = exact_dedup(documents(rows))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == brute(rows)


def test_ties_nulls_and_repeated_rows(documents):
    rows = [(5, "a b"), (3, "ab "), (3, "ab "), (None, "a  b"), (None, "z"), (9, None), (8, "")]
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(documents(rows)).collect()),
                 key=str)
    assert got == sorted([(5, None, 4, False), (3, None, 4, False), (3, None, 4, False), (None, None, 4, True),
                          (None, None, 1, True), (9, 8, 2, False), (8, 8, 2, True)], key=str)


def test_one_text_in_a_third_of_the_rows(documents, prose):
    rows = [(i, "same  text" if i % 3 == 0 else t) for i, t in enumerate(prose(300, 5, 20))]
    got = {r.doc_id: r for r in exact_dedup(documents(rows), salts=4).collect()}
    assert got[0].group_size == 100 and sum(r.kept for r in got.values() if r.doc_id % 3 == 0) == 1


def test_empty(documents):
    assert exact_dedup(documents([])).count() == 0
