import math
import zlib
from collections import Counter

import numpy as np
import pytest

from stationflow.llm import maxent

from .conftest import LONG, by_id


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def base(rows):
    train = Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            train.update(tokens(t))
    n, mass = sum(train.values()), sum(train.values()) + 0.5 * (len(train) + 1)
    return {i: (len(tokens(t)), sum(w in train for w in tokens(t)), n,
                sum(math.log10((train[w] + 0.5) / mass) for w in tokens(t))) for i, t in rows}


@pytest.mark.parametrize("head", [1 << 18, 50, 1])
def test_base_matches_brute_force(documents, prose, monkeypatch, head):
    monkeypatch.setattr(maxent, "HEAD", head)
    rows = list(enumerate(prose(80, 0, 60) + ["", None, "É é A a\ttab", "x" * 200, LONG])) + [(None, "no id")]
    got = by_id(maxent.lm_scores(documents(rows)))
    for i, (n, known, total, score) in base(rows).items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9)
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 1)


def test_probabilities_of_all_tokens_sum_to_one():
    words = [f"w{i}" for i in range(400)]
    model = maxent.Model([maxent.END, *words], list(range(500, 99, -1)), sum(range(100, 501)), 401)
    r = np.random.default_rng(2)
    for w in model.weights:
        w += r.normal(0, 0.5, w.shape).astype(np.float32)
    model.ready()
    total = sum(10 ** maxent.model_scores(model, maxent.tokenize([f"w7 w300 {w}"], model))[2] for w in words)
    unseen = 10 ** maxent.model_scores(model, maxent.tokenize(["w7 w300 unseen"], model))[2]
    beyond = model.n - sum(model.counts) + 0.5 * (model.v + 1 - len(model.counts))
    total += unseen * beyond / 0.5  # what all tokens beyond the head share
    total += 10 ** maxent.model_scores(model, maxent.tokenize(["w7 w300"], model))[2]
    assert total == pytest.approx(1, abs=1e-4)


def small_model(monkeypatch):
    monkeypatch.setattr(maxent, "CLASS_LEAST", 0)
    monkeypatch.setattr(maxent, "CONTEXT_LEAST", 0)
    words = [f"w{i}" for i in range(20)]
    model = maxent.Model([maxent.END, *words], list(range(40, 19, -1)), sum(range(20, 41)), 21)
    model.weights[0] += np.random.default_rng(5).normal(0, 0.4, len(model.weights[0])).astype(np.float32)
    return model.ready(), words


def plain_score(model, words):
    """log10 probability of each token by a softmax over the two members of every class on its
    way, from the tree and the weights alone."""
    seen, out = [1, 2], []
    bits = len(model.weights[0]).bit_length() - 1

    def weight(context, kind, top, slot):
        x = int(maxent._mix(np.array([context]), kind)[0]) ^ int(top)
        return float(model.weights[0][((x * 0x9E3779B97F4A7C15) % 2**64 >> (64 - bits)) ^ slot])

    for w in words:
        leaf = model.index[w]
        path = model.code[model.start[leaf]:model.start[leaf] + model.runs[leaf]].ravel().tolist()
        path = [c for c in path if c >> 1 < len(model.bias) - 1]
        logp = model.rest[leaf] * math.log(10)
        for k, c in enumerate(path):
            top = model.run_hash[path[k - k % maxent.DEPTH] >> 1]
            members = [0.0, float(model.bias[c >> 1]) + sum(
                weight(context, kind, top, model.slot[c >> 1]) for kind, context in enumerate(seen, 1))]
            logp += members[c & 1] - math.log(sum(map(math.exp, members)))
        out.append(logp / math.log(10))
        seen = [int(model.contexts[leaf]), seen[0]]
    return out


def test_model_equals_brute_force(monkeypatch):
    model, words = small_model(monkeypatch)
    r = np.random.default_rng(6)
    for _ in range(5):
        text = [words[i] for i in r.integers(0, 20, 30)]
        got = maxent.model_scores(model, maxent.tokenize([" ".join(text)], model))
        assert got.tolist() == pytest.approx(plain_score(model, [*(w.encode() for w in text), b""]), abs=1e-5)


def test_gradients_are_those_of_differences(monkeypatch):
    model, words = small_model(monkeypatch)
    model.weights[0] = model.weights[0].astype(np.float64)
    t = maxent.tokenize(["w1 w2 w3 w1 w2 w19", "w3 w3 w0"], model)
    sums = maxent.Sums(len(model.weights[0]))
    sums.add(model, t)
    cells = np.flatnonzero(sums.curvature)
    for cell in cells[:: max(1, len(cells) // 25)].tolist():
        values = []
        for step in (1e-4, -1e-4):
            model.weights[0][cell] += step
            values.append(maxent.model_scores(model, t).sum() * math.log(10))
            model.weights[0][cell] -= step
        assert (values[0] - values[1]) / 2e-4 == pytest.approx(sums.gradient[cell], abs=5e-3)


def test_sums_survive_their_packing():
    r = np.random.default_rng(7)
    for scale in (1e-7, 1.0, 1e7):
        x = r.normal(0, scale, 1000)
        assert np.allclose(maxent.unpacked(*maxent.packed(x)), x, rtol=1e-3, atol=scale * 1e-3)
    assert maxent.unpacked(*maxent.packed(np.zeros(4))).tolist() == [0] * 4


def test_without_weights_the_model_is_the_base(documents, prose):
    rows = list(enumerate(prose(60, 1, 60)))
    for r in maxent.lm_scores(documents(rows), rounds=0).collect():
        assert r.score == pytest.approx(r.base_score, rel=1e-5)


def test_model_learns_what_follows_what(documents):
    texts = [" ".join((["one two three"] if i % 2 else ["red green blue"]) * 30) for i in range(200)]
    got = maxent.lm_scores(documents(texts)).collect()
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > 0.7 * sum(r.base_score for r in held)


def test_repeated_rows_nothing_to_learn_from_and_empty(documents):
    twice = maxent.lm_scores(documents([(3, "a b"), (3, "a b"), (4, "zz a")])).collect()
    assert len({(r.n_known, round(r.base_score, 9)) for r in twice if r.doc_id == 3}) == 1
    only_held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = maxent.lm_scores(documents([(only_held, "a b")])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and abs(r.score) < 1e-6
    assert maxent.lm_scores(documents([])).count() == 0


CHAIN = [" ".join(f"w{(7 * i + j) % 1000}" for j in range(50)) for i in range(400)]


def test_all_words_of_the_head_are_predicted_from_their_context(documents):
    """A thousand words of like frequency, each followed by the same one."""
    held = [r for r in maxent.lm_scores(documents(CHAIN)).collect() if r.held_out]
    assert held and sum(r.score for r in held) > 0.6 * sum(r.base_score for r in held)


def test_scores_do_not_depend_on_the_split(documents):
    docs = documents(CHAIN)
    one, many = (by_id(maxent.lm_scores(docs.repartition(n))) for n in (1, 64))
    assert all(many[i].score == pytest.approx(r.score, rel=1e-4) for i, r in one.items())


def test_tails_are_shuffled_by_row_number_alone(spark, monkeypatch, documents):
    """Neither ids, hashes of texts nor places travel with the tokens beyond the head."""
    made = []

    def tail_scores(parts, counts, mass, f=maxent.tail_scores):
        made.append(f(parts, counts, mass))
        return made[-1]

    monkeypatch.setattr(maxent, "HEAD", 1)
    monkeypatch.setattr(maxent, "tail_scores", tail_scores)
    rows = [(i, f"a{i} b{i} b{i} c") for i in range(40)] + [(7, "a7 b7 b7 c")]
    got = maxent.lm_scores(documents(rows), rounds=0).collect()
    assert len(got) == 41 and all(r.n_tokens == 5 for r in got)
    assert len({(r.n_known, round(r.base_score, 9)) for r in got if r.doc_id == 7}) == 1
    plan = made[0]._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join"):]
    assert "__row_text" not in joined and "posexplode" not in joined and "__row_id" not in joined.split("Relation")[0]


def test_a_task_of_sums_covers_two_tokens_a_cell(spark, documents, monkeypatch):
    monkeypatch.setattr(maxent, "CELLS", (6, 6))
    dealt = []

    def coalesce(self, n, f=type(documents([])).coalesce):
        dealt.append(n)
        return f(self, n)

    monkeypatch.setattr(type(documents([])), "coalesce", coalesce)
    docs = documents([" ".join(f"w{j}" for j in range(23))] * 40)
    texts = docs.select(docs["text"].alias("__text"))
    model = maxent.train(texts, maxent.token_counts(texts), rounds=1)
    assert model.n == 960 and dealt == [960 // (2 * 64)]
