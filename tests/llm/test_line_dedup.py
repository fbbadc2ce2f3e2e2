from stationflow.llm.line_dedup import line_dedup

from .conftest import LONG, by_id


def brute(rows, min_sites):
    sites, first = {}, {}
    for i, text, site in rows:
        for line in (text or "").split("\n"):
            bare = line.strip(" \t\n\x0b\x0c\r")
            if bare and site is not None:
                sites.setdefault(bare, set()).add(site)
                first[bare] = min(first.get(bare, i), i)
    bad = {b for b, s in sites.items() if len(s) >= min_sites}
    out = {}
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if (b := x.strip(" \t\n\x0b\x0c\r")) not in bad or first[b] == i]
        out[i] = (None if text is None else "\n".join(kept), len(lines) - len(kept))
    return out


def test_matches_brute_force(documents, prose):
    lines = prose(20, 3, 10)
    rows = []
    for i, t in enumerate(prose(120, 5, 30)):
        own = [lines[j] + ("  " if j % 2 else "") for j in range(20) if i % (j + 2) == 0]
        rows.append((i, "\n".join([*own[:2], t, "", *own[2:]]), f"s{i % 17}"))
    rows += [(200, None, "a"), (201, "", "a"), (202, "\n\n", "a"), (203, lines[0], None), (204, LONG, "b")]
    for min_sites in (3, 8, 17):
        got = {r.doc_id: (r.text, r["__removed"]) for r in line_dedup(documents(rows), min_sites=min_sites).collect()}
        assert got == brute(rows, min_sites)


def test_sketches_of_many_sites_agree_with_exact_counts(documents):
    """Far above the threshold the sketch decides alone."""
    rows = [(i, f"common\nown {i}" if i else "common", f"site{i}") for i in range(600)]
    got = by_id(line_dedup(documents(rows), min_sites=50, lg_k=8, sigmas=2.0))
    assert got[0].text == "common" and all(got[i].text == f"own {i}" for i in range(1, 600))


def test_repeated_rows_columns_and_empty(documents):
    docs = documents([(1, "x\na", "p"), (1, "x\na", "p"), (2, "x", "q"), (None, "x\nb", "r")])
    got = line_dedup(docs, min_sites=3)
    assert got.columns == [*docs.columns, "__removed"]
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == [("1", "x\na"), ("1", "x\na"), ("2", ""), ("None", "b")]
    assert line_dedup(documents([])).count() == 0
