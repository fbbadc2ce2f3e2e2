"""Toxicity by non-negative positive-unlabelled learning.

Positives are texts confirmed as toxic; the rest of the corpus is unlabelled, with a
share of toxic texts (the class prior) among it. A linear classifier in numpy minimises

    prior * E_pos[l(g)] + max(0, E_unl[l(-g)] - prior * E_pos[l(-g)])

with the logistic loss l: what unlabelled texts cost as negatives, less what the toxic
ones among them would cost, and never less than nothing. When the second term falls
below zero, a step goes up its gradient instead.

Features are the distinct words of a text and the beginnings of longer words. Which of
them can tell is counted by Spark over a bounded sample; the classifier is fitted on it
on the driver; every text is then scored whole, in batches on the executors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW_ID, ROW_TEXT, fold, keyed, sampled, small_batches, stored

#: Bounds of the sample and of the classifier; they don't depend on the size of the data.
MAX_POSITIVE, MAX_UNLABELLED, MAX_FEATURES = 4000, 12000, 8192
MAX_LETTERS = 24
#: A feature must be in this many positives, and in this share of them.
MIN_SUPPORT, MIN_SHARE, MIN_LIFT = 4, 1 / 300, 3
REMEMBERED_WORDS = 100_000
_WORDS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_WORDS.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    """The word, and its first four and five letters where it has more."""
    found = [word] if len(word) <= MAX_LETTERS else []
    return found + [word[:n] + "-" for n in (4, 5) if len(word) > n]


@dataclass
class Classifier:
    bias: float
    weights: dict[str, float]
    known: dict[str, float] = field(default_factory=dict)

    def score(self, text: str | None) -> float:
        found = words(text)
        if len(self.known) > REMEMBERED_WORDS:
            self.known = {}
        total, known = self.bias, self.known
        for w in found:
            value = known.get(w)
            if value is None:
                value = known[w] = sum(self.weights.get(f, 0.0) for f in features_of(w))
            total += value
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def nn_pu(rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray,
          n_columns: int, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 3e-4
          ) -> tuple[float, np.ndarray]:
    """Bias and weights for texts given as (row, column) pairs; ``positive`` and
    ``unlabelled`` tell which rows belong to either sample."""
    theta = np.zeros(n_columns + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    p, u = positive / max(1, positive.sum()), unlabelled / max(1, unlabelled.sum())
    for step in range(1, steps + 1):
        g = np.bincount(rows, weights=theta[columns], minlength=len(p)) + theta[-1]
        toxic = 1 / (1 + np.exp(-np.clip(g, -50, 50)))
        loss_as_clean = np.logaddexp(0, g)
        rest = u @ loss_as_clean - prior * (p @ loss_as_clean)
        down = (u - prior * p) * toxic  # slope of the second term
        slope = down - prior * p * (1 - toxic) if rest >= 0 else -down
        grad = np.append(np.bincount(columns, weights=slope[rows], minlength=n_columns), slope.sum())
        grad[:-1] += decay * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return float(theta[-1]), theta[:-1]


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", held_out_fold: int = 0) -> Classifier:
    """Fit on at most MAX_POSITIVE confirmed texts and MAX_UNLABELLED others, the first by a
    hash of their ids, none of them from the held-out fold. The prior is the share of
    positives among the labelled rows. Without positives every text gets the same low
    score."""
    spark = docs.sparkSession
    small_batches(spark)
    usable = fold(F.col("id")) != held_out_fold
    marked = (labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y"))
              .where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y")).where(usable))
    n, n_pos = marked.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("y") == 1).cast("int")), F.lit(0))).first()
    prior = min(max(n_pos / n, 0.001), 0.9) if n else 0.01
    ids = docs.select(F.col(doc_id).alias("id")).where("id is not null").where(usable)

    chosen = (sampled(marked.where("y = 1").select("id"), MAX_POSITIVE, 1)
              .select("id", F.lit(1).alias("positive"), F.lit(0).alias("unlabelled"))
              .unionByName(sampled(ids, MAX_UNLABELLED, 2)
                           .select("id", F.lit(0).alias("positive"), F.lit(1).alias("unlabelled")))
              .groupBy("id").agg(F.max("positive").alias("positive"), F.max("unlabelled").alias("unlabelled")))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("content"))
    # MAX_POSITIVE + MAX_UNLABELLED ids at most, and one row of each: of rows with one id the
    # least by a hash of the text.
    sample = texts.join(F.broadcast(chosen), "id").select("positive", "unlabelled", "content", "id")
    one = F.min_by(F.struct("positive", "unlabelled", "content"), F.xxhash64("content")).alias("r")
    sample = sample.groupBy("id").agg(one).select("r.*")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [[f for w in words(t) for f in features_of(w)] for t in pdf["content"]]
            yield pd.DataFrame({"positive": pdf["positive"], "unlabelled": pdf["unlabelled"], "features": found})

    kinds = "positive int, unlabelled int, features array<{}>"
    counted = stored(sample.mapInPandas(extract, kinds.format("string")), "toxic-sample")
    sizes = counted.agg(F.sum("positive"), F.sum("unlabelled")).first()
    if not sizes[0] or not sizes[1]:
        return Classifier(float(np.log(0.01)), {})
    p, u = F.col("p") / sizes[0], (F.col("u") + 1) / sizes[1]
    told = (counted.select("positive", "unlabelled", F.explode("features").alias("f")).groupBy("f")
            .agg(F.sum("positive").alias("p"), F.sum("unlabelled").alias("u"))
            .where((F.col("p") >= max(MIN_SUPPORT, sizes[0] * MIN_SHARE)) & (p > MIN_LIFT * u))
            .orderBy((F.col("p") * F.log(p / u)).desc(), "f").limit(MAX_FEATURES))
    names = [r.f for r in told.select("f").collect()]
    column = {f: i for i, f in enumerate(names)}

    def columns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(features=[[column[f] for f in fs if f in column] for fs in pdf["features"]])

    small = counted.mapInPandas(columns, kinds.format("int")).toPandas()
    rows = np.repeat(np.arange(len(small)), small["features"].map(len))
    flat = np.concatenate([np.asarray(f, np.int64) for f in small["features"]] or [np.zeros(0, np.int64)])
    bias, weights = nn_pu(rows, flat, small["positive"].to_numpy(float), small["unlabelled"].to_numpy(float),
                          len(names), prior)
    return Classifier(bias, {f: float(w) for f, w in zip(names, weights)})


def score(docs: DataFrame, classifier: Classifier, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Row key and ``score`` of every row; a null text is scored as an empty one."""
    rows = keyed(docs, doc_id, text)
    schema = T.StructType([rows.schema[ROW_ID], rows.schema[ROW_TEXT], T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(classifier)  # MAX_FEATURES weights at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for pdf in batches:
            yield pdf[[ROW_ID, ROW_TEXT]].assign(score=np.array([model.score(t) for t in pdf["__text"]], float))
        model.known = {}

    small_batches(docs.sparkSession)
    return rows.mapInPandas(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
             label: str = "toxic") -> DataFrame:
    """One row per document row: id, ``held_out`` (crc32 of the id as text mod 5 is 0; false
    for a null id), ``score`` from 0 to 1 and ``predicted`` (1 from 0.5 on).

    Only texts are scored: ids, labels and other columns are no inputs. Rows without a label
    are unlabelled text; a null label is none; of repeated labels the largest counts. Null
    and empty texts get the score of a text without any feature. Repeated rows are scored
    alike. Empty tables give no rows, or one low score for all where no text is confirmed."""
    scored = score(docs, train(docs, labels, doc_id, text, label), doc_id, text)
    return scored.select(F.col(ROW_ID).alias(doc_id), (fold(F.col(ROW_ID)) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
               label: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """The documents, all columns, without those that score ``threshold`` or more. Null and empty
    texts score as texts without any feature; rows repeated with one text all stay or all go.
    An empty table gives no rows; without confirmed texts all documents stay."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, doc_id, text, label))

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for part in texts:
            yield pd.Series([model.score(t) for t in part], dtype=float)
        model.known = {}

    small_batches(docs.sparkSession)
    return docs.where(scores(F.col(text)) < threshold)
