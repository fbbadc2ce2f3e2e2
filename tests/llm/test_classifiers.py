import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.llm import quality, toxicity

from .conftest import LONG, by_id

LABELS = "doc_id bigint, quality int, toxic int, text string, score string"


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus():
    """600 texts; a tenth holds slurs (words, or endings after a common beginning), a seventh is junk."""
    r = random.Random(11)
    common = ["".join(r.choices("abcdeilmnorstu", k=r.randint(2, 8))) for _ in range(600)]
    slurs = ["blargh", "snotty"] + ["zurk" + "".join(r.choices("aeiou", k=3)) for _ in range(30)]
    rows, labels = [], []
    for i in range(600):
        words = r.choices(common, k=r.randint(30, 200))
        toxic, junk = i % 10 == 3, i % 7 == 2
        if toxic:
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(slurs))
        text = " ".join(w.upper() + "!!" for w in words) if junk else " ".join(words).capitalize() + "."
        rows.append((i, text))
        if i % 4 or i % 3 == 0:
            labels.append((i, int(not junk), int(toxic), "clash", "clash"))
    return rows, labels


def rates(got, truth):
    held = [i for i in got if held_out(i)]
    yes, no = [i for i in held if truth(i)], [i for i in held if not truth(i)]
    return np.mean([got[i].predicted for i in yes]), np.mean([got[i].predicted for i in no])


def test_toxic_texts_of_the_held_out_fold_are_found(spark, documents, corpus):
    rows, labels = corpus
    out = toxicity.toxicity(documents(rows + [(1000, None), (1001, ""), (1002, LONG), (None, "x")]),
                            spark.createDataFrame(labels + [(None, 1, 1, "", ""), (5000, None, None, "", "")], LABELS))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = by_id(out)
    recall, wrong = rates({i: got[i] for i, _ in rows}, lambda i: i % 10 == 3)
    assert recall > 0.9 and wrong < 0.05
    assert all(got[i].held_out == held_out(i) for i, _ in rows) and got[None].held_out is False
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[1000].score == got[1001].score and got[1000].predicted == got[1002].predicted == 0


def test_labels_of_the_held_out_fold_are_not_read(spark, documents, corpus):
    rows, labels = corpus
    docs = documents(rows, clashing=False)
    other = [(i, 1 - q, 1 - t, a, b) if held_out(i) else (i, q, t, a, b) for i, q, t, a, b in labels]
    for run in (toxicity.toxicity, quality.quality):
        one, two = (by_id(run(docs, spark.createDataFrame(x, LABELS))) for x in (labels, other))
        assert all(abs(one[i].score - two[i].score) < 1e-6 for i in one)


def test_drop_toxic_keeps_columns_and_clean_rows(spark, documents, corpus):
    rows, labels = corpus
    docs = documents(rows)
    kept = toxicity.drop_toxic(docs, spark.createDataFrame(labels, LABELS))
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert kept.columns == docs.columns
    assert sum(i % 10 == 3 for i in ids) <= 6 and sum(i % 10 != 3 for i in ids) >= 520


def test_risk_is_that_of_positive_and_unlabelled_texts():
    """Feature 0 marks positives, hidden ones among the unlabelled too; feature 1 is noise."""
    r = np.random.default_rng(0)
    hidden = np.arange(300) >= 100
    toxic = ~hidden | (r.random(300) < 0.3)
    noise = r.random(300) < 0.5
    rows = np.concatenate([np.nonzero(toxic)[0], np.nonzero(noise)[0]])
    columns = np.concatenate([np.zeros(toxic.sum(), int), np.ones(noise.sum(), int)])
    bias, w = toxicity.nn_pu(rows, columns, (~hidden).astype(float), hidden.astype(float), 2, 0.3)
    assert bias + w[0] > 1 and bias + w[1] < -1 and abs(w[1]) < 1


def test_junk_of_the_held_out_fold_is_found(spark, documents, corpus):
    rows, labels = corpus
    got = by_id(quality.quality(documents(rows + [(1000, None), (1001, ""), (1002, LONG), (None, "x")]),
                                spark.createDataFrame(labels + [(None, 1, 1, "", ""), (5000, None, None, "", "")], LABELS)))
    keep, wrong = rates({i: got[i] for i, _ in rows}, lambda i: i % 7 != 2)
    assert keep > 0.97 and wrong < 0.1
    assert got[1000].score == got[1001].score and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())


def test_network_gradients_are_those_of_differences():
    texts = [b"hello world " * 30, b"", b"\xc3\xa9 abc", b"XYZ! " * 100]
    y = np.array([1, 0, 1, 0], np.float32)
    data, firsts = quality.layout(texts)
    net = quality.Network(3)
    net.p = {k: w.astype(np.float64) for k, w in net.p.items()}
    grads = net.gradients(data, firsts, y)

    def loss():
        logit = net.forward(net.blocks(data, firsts), firsts)[0]
        return float(np.mean(np.logaddexp(0, logit) - y * logit))
    r = np.random.default_rng(1)
    for name, w in net.p.items():
        for _ in range(6):
            at = tuple(r.integers(0, n) for n in w.shape)
            if name == "embed":
                at = (int(r.choice(list(b"helo wrdXYZ! "))), at[1])
            old = w[at]
            w[at] = old + 1e-5
            up = loss()
            w[at] = old - 1e-5
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-4, name


def test_scores_do_not_depend_on_neighbours_or_buffers(monkeypatch, prose):
    texts = [t.encode() for t in prose(30, 0, 300)] + [b"", (LONG * 3).encode(), b"x"]
    net = quality.Network(5)
    together = net.scores(texts)
    alone = np.array([net.scores([t])[0] for t in texts])
    assert np.allclose(together, alone, atol=1e-6)
    monkeypatch.setattr(quality, "BUFFER_BYTES", 4096)
    assert np.allclose(net.scores(texts), alone, atol=1e-6)


def test_without_labels_or_rows(spark, documents):
    none = spark.createDataFrame([], LABELS)
    docs = documents([(1, "x"), (1, "x"), (2, None)])
    assert {r.predicted for r in toxicity.toxicity(docs, none).collect()} == {0}
    assert {r.score for r in quality.quality(docs, none).collect()} == {0.5}
    assert toxicity.toxicity(documents([]), none).count() == 0
    assert quality.quality(documents([]), none).select(F.col("score")).count() == 0


def test_labels_of_long_texts_are_learned_from(spark, documents, corpus):
    """Every labelled text is longer than MAX_TRAIN_BYTES, and its beginning tells nothing."""
    rows, labels = corpus
    rows = [(i, ". " * quality.MAX_TRAIN_BYTES + t * (1 + 4 * quality.MAX_TRAIN_BYTES // len(t))) for i, t in rows[:200]]
    got = by_id(quality.quality(documents(rows), spark.createDataFrame(labels[:140], LABELS)))
    kept = [got[i].score for i in got if held_out(i) and i % 7 != 2]
    junk = [got[i].score for i in got if held_out(i) and i % 7 == 2]
    assert np.mean(kept) > np.mean(junk) + 0.3
