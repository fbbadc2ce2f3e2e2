import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stationflow.llm import token_align as A
from stationflow.llm.bpe import byte_letters

from .conftest import LONG, by_id

FILES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TEXTS = ["Hello wörld, naïve café", "漢字かな交じり文 𒀀𒀁 \U0001F600\U0001F468‍\U0001F469", "a", " ", "  two  blanks ",
         "tab\tline\nfeed\r\n", "<|endoftext|> <s></s> <unk> <0x41>", "under▁score", "nul\x00byte", "é" * 50, "𒀀",
         "é decomposed ﬁ ½ Ⅷ", "don't stop 123456 €", "", None, "xÿþ", LONG, "a" * 3000, "漢" * 700]


@pytest.fixture(scope="module")
def plain():
    """Both sides as (id, bytes) lists by other functions of the libraries, or None."""
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    of = {c: i for i, c in enumerate(byte_letters())}

    def sides(text):
        if not text:
            return None
        x = a.encode_batch([" " + text], add_special_tokens=False)[0]
        left = [(i, bytes(of[c] for c in t)) for i, t in zip(x.ids, x.tokens)]
        right = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        return (left, right) if b"".join(t for _, t in left) == raw == b"".join(t for _, t in right) else None
    return sides


def ends(side):
    at, out = 0, []
    for i, raw in side:
        at += len(raw)
        out.append((i, at))
    return out


def plain_rows(rows, plain):
    parts, links = {}, {}
    for key, text in rows:
        found = plain(text)
        if not found:
            parts[key], links[key] = (0, 0, ""), []
            continue
        a, b = map(ends, found)
        cuts = sorted({e for _, e in a} & {e for _, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, e in side if low < e <= cut) for side in (a, b)))
            low = cut
        parts[key] = len(a), len(b), ";".join(groups)
        at = {e: i for i, e in b}
        links[key] = [(i, at[e]) for i, e in a if e in at]
    counts = Counter(p for found in links.values() for p in found)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return {k: (*parts[k], len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x))
            for k, x in links.items()}


def rows_of(docs):
    aligned = A.stored(A.alignments(docs, *FILES), "aligned")
    return A.count_links(aligned, A.pieces(FILES[1]))


@pytest.mark.parametrize("head", [1 << 19, 40, 0])
def test_equals_brute_force(documents, prose, plain, monkeypatch, head):
    monkeypatch.setattr(A, "HEAD_PAIRS", head)
    rows = list(enumerate(TEXTS + prose(20, 0, 60)))
    got = by_id(rows_of(documents(rows)))
    assert {i: (r.n_a, r.n_b, r.groups, r.n_links, r.n_best, r.count_sum) for i, r in got.items()} \
        == plain_rows(rows, plain)


def test_cuts_inside_characters(plain):
    with open(FILES[0], encoding="utf-8") as f, open(FILES[1], "rb") as g:
        tools = A.Tools(f.read(), g.read())
    split = 0
    for text in filter(None, TEXTS):
        x, found = A.align_text(tools, text), plain(text)
        assert (x is None) == (found is None)
        if x is not None:
            a, b = ({e for _, e in ends(side)} for side in found)
            assert x.cuts.tolist() == sorted(a & b)
            split += any(c < len((" " + text).encode()) and (" " + text).encode()[c] & 0xC0 == 0x80 for c in x.cuts.tolist())
    assert split  # some groups end within a character


@pytest.mark.parametrize("remembered", [150_000, 3])
def test_units_equal_whole_texts(prose, monkeypatch, remembered):
    """Texts put together from remembered units are those that are aligned as a whole."""
    monkeypatch.setattr(A, "REMEMBERED_UNITS", remembered)
    monkeypatch.setattr(A, "UNIT_LETTERS", 200)
    with open(FILES[0], encoding="utf-8") as f, open(FILES[1], "rb") as g:
        tools = A.Tools(f.read(), g.read())
    assert not any(A.SPACE in tools.b.id_to_piece(i).lstrip(A.SPACE) for i in range(tools.n_b))
    odd = ["a  b c", " lead", "trail ", "x \n y", "tab\tx y", "nb\u00a0sp x", "q \u2003 r", "a\x1cb c", "it's we'll 12,5 %", "▁ a"]
    texts = TEXTS + odd + prose(30, 0, 80)
    for start in range(0, len(texts), 7):
        part = texts[start:start + 7]
        for text, got in zip(part, A.align_batch(tools, part)):
            x = A.align_text(tools, text)
            want = (0, 0, "", b"") if x is None else (len(x.a), len(x.b), A.written(tools, x), A._pairs(tools, x).tobytes())
            assert got == want, text


def test_spans_repeats_nulls_and_empty_tables(documents):
    docs = documents([(1, "tok én"), (1, "tok én"), (None, "tok én"), (2, None)])
    got = A.alignments(docs, *FILES, spans=True).collect()
    assert [r.cuts for r in got if r.groups][0][-1] == len(" tok én".encode())
    counted = [tuple(r) for r in rows_of(docs).drop("groups").collect()]
    assert len(set(r[1:] for r in counted if r[0] != 2)) == 1 and len(counted) == 4
    assert A.alignments(documents([]), *FILES).count() == 0 and rows_of(documents([])).count() == 0
    assert rows_of(documents([(1, None), (2, "▁")])).agg(F.sum("n_links")).first()[0] == 0


def test_other_columns_pass_through(documents):
    aligned = A.stored(A.alignments(documents([(1, "some words")]), *FILES).select(
        "doc_id", "links", F.lit(1).alias("n"), F.lit(2).alias("pair"), F.lit(3).alias("best")), "aligned")
    row = A.count_links(aligned, A.pieces(FILES[1])).first()
    assert (row.n, row.pair, row.best) == (1, 2, 3) and row.n_links == row.n_best == row.count_sum == 2


def test_query_hashes_groups(spark):
    from stationflow.llm import queries
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = by_id(queries.queries()["op12_token_alignment"](spark, "/root/testdata/sf0.001"))
    aligned = by_id(A.alignments(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), *FILES))
    assert set(got) == set(docs)
    for i, r in got.items():
        g = aligned[i].groups
        assert r.groups_sha256 == (hashlib.sha256(g.encode()).hexdigest() if g else "")
        assert r.n_groups == (len(g.split(";")) if g else 0)


def test_a_word_is_one_unit_with_and_without_a_mark(prose):
    """Marks are aligned apart from the words before them, as in the whole text."""
    with open(FILES[0], encoding="utf-8") as f, open(FILES[1], "rb") as g:
        tools = A.Tools(f.read(), g.read())
    assert set(tools.marks) == set(A.MARKS)
    texts = ["alpha beta, gamma.", "alpha, beta. gamma; alpha? beta! gamma: alpha", "été, été", "漢, 7, '. x.. ,", " a, b, "]
    got = A.align_batch(tools, texts)
    assert {"alpha", "beta", "gamma", "été"} <= tools.new.keys() and not {"alpha,", "beta.", "été,"} & tools.new.keys()
    more = [t.replace("a ", "a, ").replace("m ", "m. ") for t in prose(20, 0, 60)]
    for text, found in zip(texts + more, got + A.align_batch(tools, more)):
        x = A.align_text(tools, text)
        want = (0, 0, "", b"") if x is None else (len(x.a), len(x.b), A.written(tools, x), A._pairs(tools, x).tobytes())
        assert found == want, text
    tools.a.pre_tokenizer = None
    assert tools._mark(",") is None
    assert all(isinstance(v, bytes) for v in tools.new.values())


def test_new_units_of_several_batches_are_remembered():
    with open(FILES[0], encoding="utf-8") as f, open(FILES[1], "rb") as g:
        tools = A.Tools(f.read(), g.read())
    batches = [[f"w{i}x{j}" for j in range(30_000)] for i in range(3)]
    for words in batches:
        A.align_batch(tools, [" ".join(words)])
    assert all(w in tools.new for words in batches for w in words)
