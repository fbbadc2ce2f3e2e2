import random
import re

import numpy as np
import pytest

from stationflow.llm import secret_scan
from stationflow.llm.automaton import Automaton

from .conftest import LONG, by_id

KEYWORD = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
ASSIGN = re.compile(rf"""({KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(k, a, z) for a, _, k, z in sorted(found)]


def fuzz(n, size=25):
    r = random.Random(3)
    parts = ["password", "passwd", "Secret", "TOKEN", "api_key", "apikey", "tok", "pass", "AKIA", "AKI", "=", ":", '"',
             "'", " ", "  ", "abc", "DEADbeef0123", "0123456789abcdef", "x" * 12, "é", "\n", "Z9", "-", "/", "😀",
             "token=secret: ", "ghp_" + "a1" * 20, "-----BEGIN RSA PRIVATE KEY-----"]
    return ["".join(r.choices(parts, k=r.randint(0, size))) for _ in range(n)]


def test_base_spans_match_plain_patterns(documents):
    texts = fuzz(1500) + ["", None, LONG + "token=abcdefabcdefabcdef" + LONG, "a" * 70_000]
    got = by_id(secret_scan.scan_secrets(documents(texts)))
    for i, t in enumerate(texts):
        spans = [tuple(s) for s in got[i].spans]
        assert [s for s in spans if s[0] in secret_scan.BASE] == brute(t or "")
        order = [r.kind for r in secret_scan.RULES]
        assert spans == sorted(spans, key=lambda s: (s[1], order.index(s[0])))
    assert {s.kind for r in got.values() for s in r.spans} == {r.kind for r in secret_scan.RULES}


@pytest.mark.parametrize("pattern", ["ab*c|d+", "(a|b)(c|a?)+", "x{2}y{1,3}z{2,}", "[^a-c]b?", r"(?i)k\d\w", r"\x41\."])
def test_automata_agree_with_re(pattern):
    forward, back = Automaton([pattern]), Automaton([pattern], backwards=True)
    r = random.Random(9)
    for _ in range(400):
        text = "".join(r.choice("abcdxyzkK1A._") for _ in range(r.randint(0, 9))).encode()
        plain = [n for n in range(len(text) + 1) if re.fullmatch(pattern.encode(), text[:n])]
        assert forward.longest(text, 0, len(text)) == max(plain, default=-1)
        plain = [n for n in range(len(text) + 1) if re.fullmatch(pattern.encode(), text[len(text) - n:])]
        assert back.longest(text, 0, len(text), back=True) == max(plain, default=-1)


def test_lanes_give_the_states_of_one_pass():
    a = Automaton([r.pattern for r in secret_scan.RULES], search=True)
    data = np.frombuffer("\n".join(fuzz(300)).encode() + b"0" * 5000 + b"token=" + b"x" * 4000, np.uint8)
    state, states = 0, []
    for b in data.tolist():
        state = int(a.step[state, a.class_of[b]])
        states.append(state)
    for lane in (7, 64, 1024, 1 << 16):
        assert a.scan(data, lane).tolist() == states


def test_minimal_automaton_is_small():
    assert len(Automaton(["(a|b)*abb"]).step) == 5  # with the state of no return
    assert len(Automaton([r.pattern for r in secret_scan.RULES], search=True).step) < 1000


def test_repeated_rows_null_ids_and_empty(documents):
    docs = documents([(1, "AKIA" + "B" * 16), (1, "AKIA" + "B" * 16), (None, "x")])
    got = sorted((str(r.doc_id), len(r.spans)) for r in secret_scan.scan_secrets(docs).collect())
    assert got == [("1", 1), ("1", 1), ("None", 0)]
    assert secret_scan.scan_secrets(documents([])).count() == 0
