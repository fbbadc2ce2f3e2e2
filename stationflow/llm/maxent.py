"""Language-model scores: a smoothed unigram base and a hashed maximum-entropy model.

The base needs the count of every token. Counts come from one aggregation over all
training texts. The ``head`` most frequent tokens (a fixed number, of bounded length) are
broadcast; the other tokens of each text are joined with the full table of counts.

The model predicts each token from the word before it (an n-gram feature) and the word before
that (a skip feature). Words of fewer than CONTEXT_LEAST counts are one context, as are
the places before a text.

The softmax is factored by classes, all the way down: a class is a node of a Huffman tree over
the tokens, its members are its two children, and P(token) is the product of the softmax
over the members of each class on the way. Over two members a softmax is a yes-or-no
decision whose logit is a sum of weights, one for each feature; so each factor, and
with it the product, is a maximum-entropy model, and no sum runs over more than two members.
Every head token has a leaf; one more leaf holds all tokens beyond the head, which share its
probability as in the base. Classes of fewer than CLASS_LEAST counts have the odds of the
base: what a context says of them can't be told from so few. A weight belongs to a feature and
a class, hashed to a cell; with no weights learned the model is the base.

Training is distributed and goes by gradient updates: the training texts are dealt into ROUNDS
parts by a hash. In a round, with fixed weights, each task adds up for every cell the gradient
of the log-likelihood (yes less expected), and in the first round its curvature, over the
texts of one part; Spark sums these over the tasks, and the weights move once, by the gradient
over the curvature of all parts so far (as many times that of the first). So each text is learned from once, and weights depend on the texts and not on
how rows are split into tasks. The number of cells grows with the tokens, up to a broadcast of
16 MB; a task covers two tokens a cell at least, so what tasks send doesn't depend on how many
cores there are, and is 2 bytes a token at most.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW_ID, blank_words, fold, keyed, lower_ascii, small_batches, stored

HEAD, HEAD_BYTES = 1 << 18, 64
CELLS, TOKENS_A_CELL = (18, 22), 4  # bits of the number of weights, at least and at most
TASK_TOKENS = 2  # tokens a cell that a task covers at least, if there are as many
CONTEXT_LEAST, CLASS_LEAST = 8, 24
ROUNDS = 3
DEPTH = 4  # decisions of a run; its part of the tree has 15, in 16 neighbouring cells
BLOCK = 1 << 14  # cells in a row of sums
CALM, SHARE = 6.0, 0.6  # curvature that every cell starts with; how much of a step each feature takes
SLICE = 1 << 13  # tokens at a time
END = ""


def token_counts(texts: DataFrame, text: str = "__text") -> DataFrame:
    """(token, c) over all rows: lower-cased words, and END once for each row."""
    words = texts.select(F.explode(blank_words(lower_ascii(F.col(text)))).alias("token"))
    counts = words.groupBy("token").agg(F.count(F.lit(1)).alias("c"))
    ends = texts.agg(F.count(F.lit(1)).alias("c")).where("c > 0").select(F.lit(END).alias("token"), "c")
    return counts.unionByName(ends)


def head_tokens(counts: DataFrame) -> DataFrame:
    """The most frequent tokens of at most HEAD_BYTES bytes, HEAD of them at most.

    A histogram over eighths of powers of two tells from which count on they fit, so
    nothing is sorted and no task gathers candidates of all others."""
    short = counts.where(F.octet_length("token") <= HEAD_BYTES)
    level = F.floor(F.log2("c") * 8)
    least, room = 0, HEAD
    for at, n in short.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # under 512 rows
        room -= n
        if room < 0:
            least = at + 1
            break
    return short.where(level >= least)


def _mix(first: np.ndarray, kind: int) -> np.ndarray:
    """64-bit hash of a feature or a class."""
    x = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def cell_bits(n: int) -> int:
    """Bits of the number of cells for ``n`` training tokens, up to the most."""
    return min(max((n // TOKENS_A_CELL).bit_length(), CELLS[0]), CELLS[1])


@dataclass
class Model:
    """Head tokens by falling count, their counts, the totals, and the weights."""

    tokens: list[str]
    counts: list[int]
    n: int
    v: int
    weights: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1 << CELLS[0], np.float32)])

    @property
    def mass(self) -> float:
        return self.n + 0.5 * (self.v + 1)

    def ready(self) -> Model:
        """Tables that each worker makes for itself."""
        if hasattr(self, "index"):
            return self
        raw = [t.encode("utf-8", "surrogatepass") for t in self.tokens]
        counts = np.array(self.counts or [0], np.int64)
        # Contexts: 0 for rare words, 1 and 2 for the places before a text.
        self.contexts = np.where(counts >= CONTEXT_LEAST, np.array([zlib.crc32(t) for t in raw] or [0]) + 3, 0)
        self.base = np.log10((counts + 0.5) / self.mass)
        self.unseen = np.log10(0.5 / self.mass)
        beyond = self.n - sum(self.counts) + 0.5 * (self.v + 1 - len(self.counts))
        self.other = np.log10(beyond / self.mass)
        self._tree([*(c + 0.5 for c in self.counts), beyond])
        self.index = {t: i for i, t in enumerate(raw)}
        return self

    def _tree(self, weight: list[float]) -> None:
        """The Huffman tree of the tokens. ``code`` lists for each leaf (the last is all beyond
        the head), from the root on, twice the class plus the member, as far as classes have
        CLASS_LEAST counts; ``rest`` is the logarithm of what the base says of the others.
        Every DEPTH levels make a run, whose classes are neighbouring cells. What a class has
        is listed again for each run of a leaf, so that it is looked up a run at a time."""
        leaves = len(weight)
        parent, side = [0] * leaves, [0] * leaves
        heap = [(w, i) for i, w in enumerate(weight)]
        heapq.heapify(heap)
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            new = len(weight)
            parent[i] = parent[j] = new
            side[j] = 1
            weight.append(a + b)
            parent.append(new)
            side.append(0)
            heapq.heappush(heap, (a + b, new))
        up, sides, mass = np.array(parent), np.array(side), np.array(weight)
        inner = max(len(weight) - leaves, 1)
        yes = np.full(inner, 0.5)
        second = np.flatnonzero(sides)
        yes[up[second] - leaves] = mass[second] / mass[up[second]]
        self.bias = np.log(yes / (1 - yes)).astype(np.float32)
        root = len(weight) - 1
        leaf = np.arange(leaves)
        at, found = leaf, []
        self.rest = np.zeros(leaves)
        while len(at):
            on = at != root
            leaf, at = leaf[on], at[on]
            learned = mass[up[at]] >= CLASS_LEAST
            small = ~learned
            self.rest[leaf[small]] += np.log10(mass[at[small]] / mass[up[at[small]]])
            found.append((leaf[learned], 2 * (up[at[learned]] - leaves) + sides[at[learned]]))
            at = up[at]
        of = np.concatenate([x for x, _ in found[::-1]] or [np.zeros(0, np.int64)])
        order = np.argsort(of, kind="stable")
        code = np.concatenate([x for _, x in found[::-1]] or [of])[order]
        length = np.bincount(of, minlength=leaves)
        # A row for each run of a leaf; places beyond its end hold a class that is surely yes.
        self.runs = -(-length // DEPTH)
        self.start = np.cumsum(self.runs) - self.runs
        self.code = np.full((self.runs.sum(), DEPTH), 2 * inner + 1, np.int32)
        place = np.arange(len(code)) - np.repeat(np.cumsum(length) - length, length)
        self.code[np.repeat(self.start, length) + place // DEPTH, place % DEPTH] = code
        self.bias = np.append(self.bias, np.float32(60))
        depth, top, slot = [0] * inner, list(range(inner)), [1] * inner
        for i in range(inner - 2, -1, -1):  # parents come after their children
            above = parent[i + leaves] - leaves
            depth[i] = depth[above] + 1
            if depth[i] % DEPTH:
                top[i], slot[i] = top[above], 2 * slot[above] + side[i + leaves]
        self.slot = np.array([*slot, 0], np.int32)
        self.run_hash = _mix(np.array([*top, 0]), 7)
        classes = self.code >> 1
        self.row_yes, self.row_bias = (self.code & 1).astype(bool), self.bias[classes]
        self.row_slot, self.row_hash = self.slot[classes].astype(np.int8), self.run_hash[classes[:, 0]]


@dataclass
class Tokens:
    """Tokens of several texts in a row: head index (-1 beyond the head), first token of each
    text and the contexts that the two words before each token are."""

    words: list[bytes]
    ids: np.ndarray
    starts: np.ndarray
    before: np.ndarray
    skipped: np.ndarray


def tokenize(texts: list[str | None], model: Model) -> Tokens:
    words: list[bytes] = []
    starts = []
    for t in texts:
        starts.append(len(words))
        words.extend((t or "").encode("utf-8", "surrogatepass").lower().split())  # ASCII rules, being bytes
        words.append(b"")
    get = model.index.get
    ids = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
    own = np.where(ids >= 0, model.contexts[np.maximum(ids, 0)], 0)
    first = np.array(starts, np.int64)
    before = np.concatenate([[1], own[:-1]]) if words else own
    before[first] = 1
    skipped = np.concatenate([[2], before[:-1]]) if words else own.copy()
    skipped[first] = 2
    return Tokens(words, ids, first, before, skipped)


def _decisions(model: Model, t: Tokens, a: int, z: int):
    """All learned decisions of the tokens in rows of DEPTH: token of each row, whether yes,
    logit, and the cells of the features."""
    leaf = np.where(t.ids[a:z] < 0, len(model.tokens), t.ids[a:z])
    runs = model.runs[leaf]
    of = np.repeat(np.arange(z - a), runs)  # the token of each run
    row = np.arange(len(of)) + np.repeat(model.start[leaf] - np.cumsum(runs) + runs, runs)
    run_hash = model.row_hash.take(row)
    table = model.weights[0]
    shift = np.uint64(64 - (len(table).bit_length() - 1))
    logit, slot, cells = model.row_bias.take(row, 0), model.row_slot.take(row, 0).astype(np.int64), []
    for kind, context in enumerate((t.before[a:z], t.skipped[a:z]), 1):
        x = ((_mix(context, kind).take(of) ^ run_hash) * np.uint64(0x9E3779B97F4A7C15)) >> shift
        cells.append(x.view(np.int64)[:, None] ^ slot)
        logit += table.take(cells[-1])
    return of, model.row_yes.take(row, 0), logit, cells


def model_scores(model: Model, t: Tokens) -> np.ndarray:
    """log10 probability of each token; a token beyond the head counts as one not seen in training."""
    out = model.rest[np.where(t.ids < 0, len(model.tokens), t.ids)] + np.where(t.ids < 0, model.unseen - model.other, 0.0)
    for a in range(0, len(out), SLICE):
        z = min(a + SLICE, len(out))
        token, yes, logit, _ = _decisions(model, t, a, z)
        against = np.exp(np.minimum(np.where(yes, -logit, logit), 80))
        out[a:z] -= np.bincount(token, weights=np.log(1 + against).sum(1, dtype=float), minlength=z - a) / np.log(10)
    return out


class Sums:
    """For each cell the gradient (yes less expected) of the log-likelihood and, if asked for, its
    curvature."""

    def __init__(self, size: int, curved: bool = True):
        self.gradient, self.curvature = np.zeros(size), np.zeros(size if curved else 0)

    def add(self, model: Model, t: Tokens) -> None:
        for a in range(0, len(t.ids), SLICE):
            _, yes, logit, cells = _decisions(model, t, a, min(a + SLICE, len(t.ids)))
            p = 1 / (1 + np.exp(-np.clip(logit, -60, 60)))
            slope = (yes - p).ravel().astype(float)
            for cell in cells:
                np.add.at(self.gradient, cell.ravel(), slope)
            if len(self.curvature):
                bend = (p * (1 - p)).ravel().astype(float)
                for cell in cells:
                    np.add.at(self.curvature, cell.ravel(), bend)


def packed(values: np.ndarray) -> tuple[float, bytes]:
    """Numbers as shares of the largest, in 16 bits each."""
    most = float(np.abs(values).max(initial=0)) or 1.0
    return most, (values / most).astype(np.float16).tobytes()


def unpacked(most: float, raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.float16).astype(float) * most


SUMS = "block int, g double, gradient binary, c double, curvature binary"
SUM_COLUMNS = ["block", "g", "gradient", "c", "curvature"]


def _sum_rows(sums: Sums) -> Iterator[pd.DataFrame]:
    for block in range(0, -(-len(sums.gradient) // BLOCK)):
        at = slice(block * BLOCK, (block + 1) * BLOCK)
        if sums.gradient[at].any():
            yield pd.DataFrame([(block, *packed(sums.gradient[at]), *packed(sums.curvature[at]))], columns=SUM_COLUMNS)


def _total(pdf: pd.DataFrame) -> pd.DataFrame:
    gradient = sum(unpacked(m, b) for m, b in zip(pdf["g"], pdf["gradient"]))
    curvature = sum(unpacked(m, b) for m, b in zip(pdf["c"], pdf["curvature"]))
    return pd.DataFrame([(pdf["block"].iloc[0], *packed(gradient), *packed(curvature))], columns=SUM_COLUMNS)


def train(texts: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> Model:
    """A model of ``texts`` (column __text), each learned from in one of the rounds."""
    spark = texts.sparkSession
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    head = head_tokens(counts).toPandas().sort_values(["c", "token"], ascending=[False, True])
    size = 1 << cell_bits(int(n))
    model = Model(head["token"].tolist(), head["c"].tolist(), int(n), int(v), [np.zeros(size, np.float32)])
    small_batches(spark)
    part = F.pmod(F.xxhash64("__text"), F.lit(rounds))
    tasks = max(1, int(n or 0) // (TASK_TOKENS * max(rounds, 1) * size))
    curvature = np.zeros(size)  # of one part; the parts are alike, so the first is told for all
    for nth in range(rounds if n else 0):
        sent = spark.sparkContext.broadcast(model)  # head and weights: of bounded size

        first = nth == 0

        def learn(batches: Iterator[pd.DataFrame], sent=sent, first=first) -> Iterator[pd.DataFrame]:
            given = sent.value.ready()
            sums = Sums(size, first)
            for pdf in batches:
                sums.add(given, tokenize(pdf["__text"].tolist(), given))
            yield from _sum_rows(sums)

        rows = texts.where(part == nth).select("__text").coalesce(tasks)
        summed = rows.mapInPandas(learn, SUMS).groupBy("block").applyInPandas(_total, SUMS).toPandas()
        for r in summed.itertuples():
            at = slice(r.block * BLOCK, (r.block + 1) * BLOCK)
            if first:
                curvature[at] = unpacked(r.c, r.curvature)
            model.weights[0][at] += (SHARE * unpacked(r.g, r.gradient) / (CALM + (nth + 1) * curvature[at])).astype(np.float32)
        sent.destroy()
    return model


def tail_scores(parts: DataFrame, counts: DataFrame, mass: float) -> DataFrame:
    """For each ``row`` of ``parts`` with a tail, what its tokens add: ``tail_base`` and
    ``tail_known``. Nothing but a row's number, a token and how often it occurs is shuffled."""
    tokens = parts.select("row", F.explode("tail").alias("t")).select("row", "t.token", "t.k")
    return (tokens.join(counts, "token", "left").groupBy("row")
            .agg(F.sum(F.col("k") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / mass)).alias("tail_base"),
                 F.sum(F.when(F.col("c").isNotNull(), F.col("k")).otherwise(0)).alias("tail_known")))


def lm_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out_fold: int = 1,
              rounds: int = ROUNDS) -> DataFrame:
    """One row per document row: id, ``held_out`` (crc32 of the id as text mod 5 is
    ``held_out_fold``; a null id is not), ``n_tokens``, ``n_known`` (tokens seen in training),
    ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities of the text).

    A null or empty text is its end token alone. Held-out rows are scored and not learned
    from; without training texts every token has probability one. Rows repeated with one
    id and text are learned from each time and scored alike. An empty table gives no
    rows. Other columns are not read."""
    spark = docs.sparkSession
    rows = keyed(docs, doc_id, text)
    texts = rows.where(fold(F.col(ROW_ID)) != held_out_fold).select("__text")
    counts = stored(token_counts(texts), "token-counts")
    model = train(texts.withColumn("__text", F.coalesce("__text", F.lit(""))), counts, rounds)
    sent = spark.sparkContext.broadcast(model)
    tail = T.ArrayType(T.StructType([T.StructField("token", T.StringType()), T.StructField("k", T.LongType())]))
    schema = T.StructType([rows.schema[ROW_ID], T.StructField("n_tokens", T.LongType()),
                           T.StructField("known", T.LongType()), T.StructField("base", T.DoubleType()),
                           T.StructField("model", T.DoubleType()), T.StructField("tail", tail)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value.ready()
        for pdf in batches:
            t = tokenize(pdf["__text"].tolist(), m)
            in_head = t.ids >= 0
            base = np.where(in_head, m.base[np.maximum(t.ids, 0)], 0.0)
            full = model_scores(m, t) - np.where(in_head, 0.0, m.unseen)  # their counts are joined
            ends = np.append(t.starts[1:], len(t.ids))
            rest = [[{"token": w.decode("utf-8", "surrogatepass"), "k": k} for w, k in Counter(
                [t.words[i] for i in (np.nonzero(~in_head[a:z])[0] + a).tolist()]).items()]
                for a, z in zip(t.starts.tolist(), ends.tolist())]
            yield pdf[[ROW_ID]].assign(
                n_tokens=ends - t.starts, known=np.add.reduceat(in_head.astype(np.int64), t.starts),
                base=np.add.reduceat(base, t.starts), model=np.add.reduceat(full, t.starts), tail=rest)

    # Numbered as they are written, so that a row keeps its number and repeated rows have one each.
    scored = rows.select(ROW_ID, "__text").mapInPandas(run, schema)
    parts = stored(scored.withColumn("row", F.monotonically_increasing_id()), "lm-parts", "zstd")
    tails = tail_scores(parts, counts, model.mass)
    none = F.lit(0.0)
    return parts.drop("tail").join(tails, "row", "left").select(
        F.col(ROW_ID).alias(doc_id), (fold(F.col(ROW_ID)) == held_out_fold).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", none)).alias("base_score"),
        (F.col("model") + F.coalesce("tail_base", none)).alias("score"))
