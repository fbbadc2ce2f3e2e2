"""Quality by a byte-level convolutional network in numpy.

Bytes are embedded; learned filters of eight bytes move in steps of four; the responses
are max-pooled over overlapping chunks of 256 bytes that begin every 128 bytes and cover
the whole document. A hidden layer rates each chunk; the largest and the mean ratings of
all chunks give one probability. The network is fitted by backpropagation on a bounded
sample on the driver, and every text is scored whole on the executors, a buffer at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, sampled, small_batches

#: Bounds of the training sample: rows of each label, and bytes of a training text. Of a longer
#: one, pieces of PIECE bytes are taken in even steps from its first to its last byte.
MAX_ROWS_A_LABEL, MAX_TRAIN_BYTES, PIECE = 1200, 8192, 512
STEP, BLOCK = 4, 32  # bytes a step, steps a block; a chunk is two neighbouring blocks
WIDTH, FILTERS, HIDDEN = 8, 32, 16  # of the embedding, and of the two layers
BUFFER_BYTES = 1 << 20


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of bytes, every text padded with zeros to whole blocks, and the first
    block of each text and of the end. An empty text is one block of zeros."""
    span = STEP * BLOCK
    blocks = np.array([max(1, -(-len(t) // span)) for t in texts])
    data = np.zeros(int(blocks.sum()) * span, np.uint8)
    firsts = np.concatenate([[0], np.cumsum(blocks)])
    for t, b in zip(texts, firsts):
        data[b * span:b * span + len(t)] = np.frombuffer(t, np.uint8)
    return data, firsts


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f32 = np.float32
        self.p = {
            "embed": r.normal(0, 0.5, (256, WIDTH)).astype(f32),
            "filters": r.normal(0, 0.15, (2 * STEP * WIDTH, FILTERS)).astype(f32),
            "filter_bias": np.zeros(FILTERS, f32),
            "dense": r.normal(0, 0.25, (FILTERS, HIDDEN)).astype(f32),
            "dense_bias": np.zeros(HIDDEN, f32),
            "out": r.normal(0, 0.2, 2 * HIDDEN).astype(f32),
            "out_bias": np.zeros(1, f32),
        }

    def blocks(self, data: np.ndarray, firsts: np.ndarray, places: bool = False):
        """Largest response of each filter in each block (and the step where it is)."""
        p, half = self.p, STEP * WIDTH
        groups = p["embed"][data].reshape(-1, half)
        both = groups @ np.concatenate([p["filters"][:half], p["filters"][half:]], axis=1)
        response = both[:, :FILTERS].copy()
        response[:-1] += both[1:, FILTERS:]
        zero = np.tile(p["embed"][0], STEP) @ p["filters"][half:]
        ends = firsts[1:] * BLOCK - 1  # nothing of the next text
        response[ends] = both[ends, :FILTERS] + zero
        response = response.reshape(-1, BLOCK, FILTERS)
        top = np.maximum(response.max(1) + p["filter_bias"], 0)
        return (top, response.argmax(1)) if places else top

    def chunks(self, top: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Left block of each chunk, and the first chunk of each text: a chunk is a block and
        its successor; the only block of a text is a chunk by itself."""
        counts = np.maximum(np.diff(firsts) - 1, 1)
        starts = np.concatenate([[0], np.cumsum(counts)])
        left = np.arange(starts[-1]) + np.repeat(firsts[:-1] - starts[:-1], counts)
        return left, starts

    def forward(self, top: np.ndarray, firsts: np.ndarray):
        p = self.p
        left, starts = self.chunks(top, firsts)
        alone = np.repeat(np.diff(firsts) == 1, np.diff(starts))
        right = np.where(alone, left, left + 1)
        pooled = np.maximum(top[left], top[right])
        hidden = np.maximum(pooled @ p["dense"] + p["dense_bias"], 0)
        most = np.maximum.reduceat(hidden, starts[:-1])
        mean = np.add.reduceat(hidden, starts[:-1]) / np.diff(starts)[:, None]
        logit = np.concatenate([most, mean], axis=1) @ p["out"] + p["out_bias"]
        return logit, (left, right, starts, pooled, hidden, most, mean)

    def gradients(self, data: np.ndarray, firsts: np.ndarray, y: np.ndarray) -> dict:
        p, half = self.p, STEP * WIDTH
        top, place = self.blocks(data, firsts, places=True)
        logit, (left, right, starts, pooled, hidden, most, mean) = self.forward(top, firsts)
        d = ((1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)
        text_of = np.repeat(np.arange(len(y)), np.diff(starts))
        grads = {"out": np.concatenate([most, mean], axis=1).T @ d, "out_bias": d.sum(keepdims=True)}
        is_most = hidden == most[text_of]
        ties = np.add.reduceat(is_most, starts[:-1], dtype=np.float32)
        d_hidden = d[text_of, None] * (p["out"][:HIDDEN] * is_most / ties[text_of]
                                       + p["out"][HIDDEN:] / np.diff(starts)[text_of, None])
        d_hidden = np.where(hidden > 0, d_hidden, 0).astype(np.float32)
        grads |= {"dense": pooled.T @ d_hidden, "dense_bias": d_hidden.sum(0)}
        d_pooled = d_hidden @ p["dense"].T
        d_top = np.zeros_like(top)
        by_left = top[left] >= top[right]
        np.add.at(d_top, left, np.where(by_left, d_pooled, 0))
        np.add.at(d_top, right, np.where(by_left, 0, d_pooled))
        d_top[top <= 0] = 0
        grads["filter_bias"] = d_top.sum(0)
        # Only the winning step of each block and filter learns.
        span = 2 * STEP
        at = ((np.arange(len(top))[:, None] * BLOCK + place) * STEP)[..., None] + np.arange(span)
        last = np.repeat(firsts[1:] * BLOCK * STEP, np.diff(firsts))[:, None, None]
        seen = np.where(at < last, data[np.minimum(at, len(data) - 1)], 0)
        window = p["embed"][seen].reshape(len(top), FILTERS, 2 * half)
        grads["filters"] = np.einsum("bfk,bf->kf", window, d_top)
        d_window = (d_top[..., None] * p["filters"].T[None]).reshape(-1, WIDTH)
        flat = seen.ravel()
        grads["embed"] = np.stack([np.bincount(flat, weights=d_window[:, c], minlength=256)
                                   for c in range(WIDTH)], axis=1)
        return grads

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability for each text; buffers bound the memory, texts of any length are
        pooled block by block."""
        out = np.empty(len(texts))
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) <= BUFFER_BYTES):
                size += len(texts[last])
                last += 1
            data, firsts = layout(texts[first:last])
            if last - first == 1 and len(data) > BUFFER_BYTES:
                top = self._long(data)
            else:
                top = self.blocks(data, firsts)
            logit = self.forward(top, firsts)[0]
            out[first:last] = 1 / (1 + np.exp(-np.clip(logit.astype(float), -50, 50)))
            first = last
        return out

    def _long(self, data: np.ndarray) -> np.ndarray:
        """Blocks of one very long text; each part sees the first bytes of the next."""
        span, parts = STEP * BLOCK, []
        for a in range(0, len(data), BUFFER_BYTES):
            part = data[a:a + BUFFER_BYTES + span]
            top = self.blocks(part, np.array([0, len(part) // span]))
            parts.append(top[:BUFFER_BYTES // span])
        return np.concatenate(parts)


def fit(texts: list[bytes], y: np.ndarray, epochs: int = 10, batch: int = 16, rate: float = 4e-3,
        seed: int = 7) -> Network:
    net, r = Network(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(w) for k, w in net.p.items()}
    v = {k: np.zeros_like(w) for k, w in net.p.items()}
    step, total = 0, epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = r.permutation(len(texts))
        for a in range(0, len(order), batch):
            chosen = order[a:a + batch]
            data, firsts = layout([texts[i] for i in chosen])
            step += 1
            now = rate * (1 - step / (total + 1))
            for k, g in net.gradients(data, firsts, y[chosen]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                move = m[k] / (1 - 0.9 ** step) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
                net.p[k] -= (now * move).astype(np.float32)
    return net


def training_bytes(content: Column) -> Column:
    """The bytes of a text, or of a long one MAX_TRAIN_BYTES // PIECE pieces, spread over all of it."""
    raw = F.coalesce(content, F.lit("")).cast("binary")
    last = MAX_TRAIN_BYTES // PIECE - 1
    pieces = F.aggregate(F.sequence(F.lit(0), F.lit(last)), F.lit(b""), lambda done, i: F.concat(
        done, F.substring(raw, F.floor(i.cast("bigint") * (F.octet_length(raw) - PIECE) / last).cast("int") + 1, F.lit(PIECE))))
    return F.when(F.octet_length(raw) <= MAX_TRAIN_BYTES, raw).otherwise(pieces)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", held_out_fold: int = 0) -> Network:
    """Fit on at most MAX_ROWS_A_LABEL rows of each label, long texts by MAX_TRAIN_BYTES bytes,
    taken from the first labelled ids by a hash, none from the held-out fold. Both labels
    weigh alike in the sample; the bias is then set right for their shares among the
    labelled rows. Without examples of both labels, every score is the share of label 1
    (one half if there is none)."""
    usable = fold(F.col("id")) != held_out_fold
    marked = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
              .where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y")).where(usable))
    share = dict(marked.groupBy("y").count().collect())
    chosen = sampled(marked.where("y = 0"), 2 * MAX_ROWS_A_LABEL).unionByName(
        sampled(marked.where("y = 1"), 2 * MAX_ROWS_A_LABEL))
    small = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("content"))
    known = small.join(F.broadcast(chosen), "id")  # four times MAX_ROWS_A_LABEL ids at most
    known = known.select("id", "y", training_bytes(F.col("content")).alias("content"))
    rows = [r for y in (0, 1) for r in known.where(F.col("y") == y)
            .orderBy(F.xxhash64("id"), "id").limit(MAX_ROWS_A_LABEL).collect()]
    y = np.array([r.y for r in rows], np.float32)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    if not n0 or not n1:
        net = Network()
        net.p["out"][:] = 0
        net.p["out_bias"][:] = np.log((share.get(1, 0) + 1) / (share.get(0, 0) + 1))
        return net
    net = fit([bytes(r.content) for r in rows], y)
    net.p["out_bias"] += np.float32(np.log(share[1] / share[0]) - np.log(n1 / n0))
    return net


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
            label: str = "quality", threshold: float = 0.3) -> DataFrame:
    """One row per document row: id, ``held_out`` (crc32 of the id as text mod 5 is 0; false
    for a null id), ``score`` from 0 to 1 and ``predicted`` (1 from ``threshold`` on).

    Only the bytes of the text are an input. A null text is scored as an empty one, which
    is one chunk of zeros. Null labels are none; of repeated ones the largest counts.
    Repeated rows are scored alike. Empty tables give no rows, or one score for all."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(train(docs, labels, doc_id, text, label))  # of fixed size
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("content"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = shared.value
        for pdf in batches:
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in pdf["content"]]
            yield pd.DataFrame({"id": pdf["id"], "score": net.scores(raw)})

    small_batches(spark)
    scored = rows.mapInPandas(run, T.StructType([rows.schema["id"], T.StructField("score", T.DoubleType())]))
    return scored.select(F.col("id").alias(doc_id), (fold(F.col("id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
