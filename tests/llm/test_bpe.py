import random

import pytest

from stationflow.llm import bpe

from .conftest import LONG, by_id

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def wanted(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)


def fuzz(n):
    r = random.Random(1)
    parts = list("aaabbbAZ09 \t\n\r\x0b\x0c\x1c\x1f\x85\xa0'’sStTreVEmMllLdD!!..éÉèßẞİıΣσςǅŒ½²Ⅷ٣一二ก้é​　😀\x00\x7f<|>")
    parts += ["<|startoftext|>", "<|endoftext|>", "'re", "'LL", "ΑΣ", "ﬁ", "<|start"]
    return ["".join(r.choices(parts, k=r.randint(0, 40))) for _ in range(n)]


def test_equals_the_library(documents, prose, library):
    texts = fuzz(800) + prose(100) + ["", None, "a" * 3000, "ab" * 2000, "!" * 500, LONG]
    got = by_id(bpe.encode(documents(texts), PATH))
    assert {i: (r.n_tokens, r.ids, r.decoded) for i, r in got.items()} == \
        {i: wanted(library, t) for i, t in enumerate(texts)}


def test_merges_of_a_batch_are_those_of_each_word(library):
    with open(PATH, encoding="utf-8") as f:
        vocabulary = bpe.Vocabulary(f.read())
    words = ["aaaa", "aaaaa", "lowering", "low", "é", "zzzz", "abab", "the", "a", "'s"]
    together = vocabulary.encode_words(words)
    assert together == [vocabulary.encode_words([w])[0] for w in words]
    assert together == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_forgetting_words_changes_nothing(monkeypatch, prose):
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    texts = prose(60)
    free, tight = bpe.Vocabulary(spec), bpe.Vocabulary(spec)
    split = bpe.splitter(free)
    batches = [split(t) for t in texts]
    for words in batches:
        free.learn(set(words))
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 60)
    for words in batches:
        tight.learn(set(words))
        assert all(tight.known[w] == free.known[w] for w in words)
        assert len(tight.known) <= 60 + len(set(words)) + 2


def test_repeated_rows_null_ids_and_empty(documents):
    got = bpe.encode(documents([(1, "x y"), (1, "x y"), (None, "x y")]), PATH).collect()
    assert len({r.ids for r in got}) == 1 and sorted(str(r.doc_id) for r in got) == ["1", "1", "None"]
    assert bpe.encode(documents([]), PATH).count() == 0
