import re

import pytest

from stationflow.llm.decontaminate import decontaminate, drop_contaminated

from .conftest import LONG, by_id

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(rows, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[a:a + window]), set()).add(item)
    out = {}
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in wins}:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in wins:
                    hit.update(range(a, a + n))
                    found |= wins[tuple(w[a:a + n])]
        spans = [(p, min(q for q in range(p, len(w) + 1) if q not in hit)) for p in sorted(hit) if p - 1 not in hit]
        out[i] = (len(w), len(hit), spans, sorted(str(x) for x in found if x is not None), bool(hit))
    return out


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def got(docs, items, **params):
    return {r.doc_id: (r.n_words, r.n_hit, [tuple(s) for s in r.spans], r.item_ids, r.contaminated)
            for r in decontaminate(docs, items, **params).collect()}


def test_matches_brute_force(spark, documents, prose):
    texts, items = prose(60, 0, 120), list(enumerate(prose(12, 8, 60)))
    rows = []
    for i, t in enumerate(texts):  # a passage of an item in a third of the documents
        w = items[i % 12][1].split()
        cut = w[i % 7:i % 7 + 6 + i % 9]
        rows.append((i, t + " " + " ".join(cut).upper() + ", " + t if i % 3 == 0 else t))
    rows += [(100, None), (101, ""), (102, " ".join(t for _, t in items)), (103, "be " * 50), (104, LONG)]
    items += [(50, None), (51, ""), (52, "be be be be be be be be be be be"), (53, items[0][1]), (None, items[1][1])]
    assert got(documents(rows), items_frame(spark, items)) == brute(rows, items)


def test_items_shorter_than_a_window(spark, documents, prose):
    rows = list(enumerate(prose(30, 0, 40) + ["alpha beta", "x alpha BETA gamma y", "word", "alpha"]))
    items = [(1, "alpha beta"), (2, "Word"), (3, "alpha beta gamma"), (10, "beta gamma y"), (4, rows[0][1])]
    assert got(documents(rows), items_frame(spark, items)) == brute(rows, items)


@pytest.mark.parametrize("window,gram", [(4, 2), (3, 2), (5, 1)])
def test_other_windows(spark, documents, prose, window, gram):
    rows, items = list(enumerate(prose(30, 0, 60))), list(enumerate(prose(5, 2, 30)))
    assert got(documents(rows), items_frame(spark, items), window=window, gram=gram) == brute(rows, items, window)


def test_repeated_rows_and_empty_tables(spark, documents, prose):
    text = prose(1, 30, 30)[0]
    docs = documents([(1, text), (1, text), (None, text), (2, "clean")])
    found = decontaminate(docs, items_frame(spark, [(7, text)])).collect()
    assert sorted((str(r.doc_id), r.n_hit) for r in found) == [("1", 30), ("1", 30), ("2", 0), ("None", 30)]
    assert not any(r.contaminated for r in decontaminate(docs, items_frame(spark, [])).collect())
    assert decontaminate(documents([]), items_frame(spark, [(7, text)])).count() == 0
    kept = drop_contaminated(docs, items_frame(spark, [(7, text)]))
    assert kept.columns == docs.columns and list(by_id(kept)) == [2]
