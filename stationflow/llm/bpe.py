"""BPE encoding and decoding with a pair occurrence index.

All new words of a batch are laid out in one array of symbols. An index maps the rank of
every pair to all places in the batch where that pair occurs. The smallest active rank
is applied to all its places at once, the pairs around the merged places enter the
lists of their own ranks, and so on until no rank is active. As a word's merges depend
on that word alone, this gives each word what merging it by itself would.

Words and their pieces are remembered by each Python worker up to a fixed number, those met
again longest, so a frequent word is encoded once. The vocabulary is read on the driver and broadcast; its
size does not depend on the data.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

REMEMBERED_WORDS = 120_000
_NEVER = np.int64(1) << 40


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself
    where it is printable Latin-1, else the next unused one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Pieces, ranked merges and special tokens of a tokenizer file: byte-level BPE with an
    end-of-word suffix, lower case, NFC, no decoder (pieces are joined by blanks)."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] is None or data["decoder"] is not None:
            raise ValueError("expected a BPE file with an end-of-word suffix and no decoder")
        self.suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.pieces = {i: p for p, i in (self.ids | self.special).items()}
        self.base = max(self.pieces) + 1
        ranked = np.array([(self.ids[a] * self.base + self.ids[b], rank, self.ids[a + b])
                           for rank, (a, b) in enumerate(model["merges"])], np.int64).reshape(-1, 3)
        ranked = ranked[np.argsort(ranked[:, 0], kind="stable")]
        self.pairs, self.ranks = ranked[:, 0].copy(), ranked[:, 1].copy()
        self.merged = np.empty(len(ranked), np.int64)
        self.merged[ranked[:, 1]] = ranked[:, 2]
        letters = byte_letters()
        self.inner = np.array([self.ids[c] for c in letters], np.int64)
        self.final = np.array([self.ids[c + self.suffix] for c in letters], np.int64)
        cutters = data["pre_tokenizer"]["pretokenizers"]
        self.pattern = next(c["pattern"]["Regex"] for c in cutters if c["type"] == "Split")
        # Pieces of the words met lately, and of those before.
        self.known: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; _NEVER where there is no merge or a side is missing."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pairs[at] == key), self.ranks[at], _NEVER)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(sizes)
        symbol = np.append(self.inner[flat], -1)  # one more place: what is beyond either end
        symbol[ends - 1] = self.final[flat[ends - 1]]
        n = len(flat)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1], before[ends - sizes], after[n], before[n] = n, n, n, n
        rank = self.rank_of(symbol, symbol[after])
        places: dict[int, list[int]] = {}

        def index(at: np.ndarray) -> None:
            for r, p in zip(rank[at].tolist(), at.tolist()):
                if r in places:
                    places[r].append(p)
                elif r < _NEVER:
                    places[r] = [p]
                    heapq.heappush(active, r)

        active: list[int] = []
        index(np.nonzero(rank < _NEVER)[0])
        while active:
            now = heapq.heappop(active)
            left = np.unique(np.array(places.pop(now), np.int64))
            left = left[rank[left] == now]
            if not len(left):
                continue
            right = after[left]
            if symbol[left[0]] == symbol[right[0]]:  # a run of equal symbols: pairs from its start
                free, taken = [], -1
                for a, b in zip(left.tolist(), right.tolist()):
                    if a != taken:
                        free.append(a)
                        taken = b
                left = np.array(free, np.int64)
                right = after[left]
            symbol[left] = self.merged[now]
            symbol[right], rank[right] = -1, _NEVER
            after[left] = after[right]
            before[after[left]] = left
            before[n] = n
            ahead = before[left]
            touched = np.unique(np.concatenate([left, ahead[ahead < n]]))
            rank[touched] = self.rank_of(symbol[touched], symbol[after[touched]])
            index(touched)
        alive = symbol[:n] >= 0
        cuts = np.cumsum(np.add.reduceat(alive, ends - sizes, dtype=np.int64)).tolist()
        flat_ids = symbol[:n][alive].tolist()
        return [flat_ids[a:z] for a, z in zip([0, *cuts], cuts)]

    def learn(self, words: Iterable[str]) -> None:
        """Remember the pieces of words that are not remembered yet. When half of the room is
        full, words that aren't met again are forgotten at the next turn."""
        met = set(words)
        if 2 * len(self.known) > REMEMBERED_WORDS:
            self.known, self.older = {}, self.known
        self.known.update((w, self.older[w]) for w in met & self.older.keys())
        new = [w for w in met if w not in self.known]
        for w, ids in zip(new, self.encode_words(new) if new else ()):
            self.known[w] = (len(ids), " ".join(map(str, ids)), " ".join([self.pieces[i] for i in ids]))
        for content, i in self.special.items():
            self.known[content] = (1, str(i), content)


def splitter(vocabulary: Vocabulary):
    """text -> words as the tokenizer cuts them; special tokens are words of their own."""
    import regex

    general = regex.compile(vocabulary.pattern)
    ascii_only = re.compile(vocabulary.pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"), re.ASCII)
    special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")")

    def plain(part: str) -> list[str]:
        if part.isascii():
            # The separators U+001C to U+001F are blanks for Python's text patterns but not here.
            return ascii_only.findall(part.lower())
        part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # no final sigma
        return general.findall(part.lower())

    def split(text: str) -> list[str]:
        if "<|" not in text:
            return plain(text)
        out: list[str] = []
        for part in special.split(text):
            out.extend([part] if part in vocabulary.special else plain(part))
        return out

    return split


def _encoder(spec_of):
    """The worker's vocabulary, kept between tasks of one Python worker."""
    spec = spec_of.value
    held = _HELD.get(hash(spec))
    if held is None:
        vocabulary = Vocabulary(spec)
        held = _HELD[hash(spec)] = (vocabulary, splitter(vocabulary))
    return held


_HELD: dict = {}


def encode(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: id, ``n_tokens``, ``ids`` (decimal ids joined by one blank) and
    ``decoded`` (the text that decoding the ids gives, special tokens included).

    ``tokenizer`` is the path of a tokenizer file, read on the driver. A null or empty
    text has no tokens and decodes to the empty text. Whole texts are encoded, however
    long. Repeated rows are encoded alike; an empty table gives no rows. Other columns
    are not read."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("content"))
    schema = T.StructType([rows.schema["id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.StringType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary, split = _encoder(spec)
        for pdf in batches:
            texts = pdf["content"].tolist()
            cut = [split(t) if t else [] for t in texts]
            fresh: set[str] = set()
            fresh.update(*cut)
            vocabulary.learn(fresh)
            known = vocabulary.known
            out = []
            for words in cut:
                found = list(map(known.__getitem__, words))
                out.append((sum(w[0] for w in found), " ".join([w[1] for w in found]),
                            " ".join([w[2] for w in found])))
            n, ids, decoded = zip(*out) if out else ((), (), ())
            yield pd.DataFrame({"id": pdf["id"], "n_tokens": np.array(n, np.int64), "ids": list(ids),
                                "decoded": list(decoded)})

    small_batches(spark, 250, "2m")
    return rows.mapInPandas(run, schema).withColumnRenamed("id", doc_id)
