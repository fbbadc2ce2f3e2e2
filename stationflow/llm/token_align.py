"""Alignment of the tokens of two tokenizers, by byte offsets.

Tokenizer A is a byte-level BPE of the tokenizers library, B a sentencepiece model with byte
fallback. Both cut the same bytes: a space and the text, where B adds the space itself.

The libraries tell a span for every token: A in characters, B in bytes of the text. The end
of a span is a coarse cut, exact wherever the next span begins behind it. Inside a character
of several bytes spans don't tell: tokens of A that share a character all span it whole, and
byte-fallback tokens of B span nothing but the last, which spans the character. There the
cuts come from the bytes that the tokens decode to, counted from the last exact cut.

Neither tokenizer has a token that goes on behind a single blank between two words, so what
stands between such blanks (a unit) is cut alike wherever it occurs. A worker aligns the new
units of a batch in one go and remembers them up to a fixed number, each as one short
piece of bytes. A mark behind the last letter of a unit (a comma, say) is cut off first, if
neither tokenizer joins it to letters: a word is then the same unit with and without it.

Where tokens of both end, the text is cut into groups. Each group's last tokens, which end
together, are a link. Links are counted over the corpus by pair of ids. The most frequent
pairs (a fixed number) are looked up in a broadcast table, the rest by a join.
"""

from __future__ import annotations

import gc
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import byte_letters
from .common import small_batches, stored

HEAD_PAIRS = 1 << 19  # pairs of the broadcast table, 17 bytes each
FLUSH = 1 << 21  # distinct pairs that a task holds while it counts
SPACE = "▁"
REMEMBERED_UNITS, NEW_UNITS = 200_000, 200_000  # those that other batches met too, and those of one batch
UNIT_LETTERS = 1 << 14  # letters of new units that are aligned at a time
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_SIZES = struct.Struct("<3I")
MARKS = ",.;:!?"
LETTERS = frozenset(c for c in map(chr, range(0x530)) if c.isalpha())  # Latin, Greek and Cyrillic: old, so the same everywhere


class Tools:
    """Both tokenizers, and for each id the bytes and the texts that groups are written with."""

    def __init__(self, spec_a: str, model_b: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_proto=model_b)
        byte_of = {c: i for i, c in enumerate(byte_letters())}
        entries = self.a.get_vocab(with_added_tokens=True)
        self.n_a, self.n_b = max(entries.values()) + 1, self.b.get_piece_size()
        self.bytes_a = [b""] * self.n_a
        for entry, i in entries.items():
            plain = all(c in byte_of for c in entry)
            self.bytes_a[i] = bytes(byte_of[c] for c in entry) if plain else entry.encode()
        self.bytes_b = [self._piece(i) for i in range(self.n_b)]
        self.long_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.long_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Ids as written in a group: followed by a comma, or by what ends their side of it.
        self.text_a = np.array([f"{i}{end}" for end in ",|" for i in range(self.n_a)], object)
        self.text_b = np.array([f"{i}{end}" for end in ",;" for i in range(self.n_b)], object)
        # Numbers of tokens of A, of B and of pairs, packed pairs, groups as text: of units that
        # several batches met, lately and before, and of those that one met.
        self.units: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}
        self.new: dict[str, bytes | None] = {}
        self.marks = {c: x for c in MARKS if (x := self._mark(c))}

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()

    def _mark(self, mark: str) -> tuple[int, int, bytes, bytes] | None:
        """What ``mark`` adds behind a letter and before a blank. None unless A cuts its text before
        and behind the mark for every letter, and B has no piece that goes over either place."""
        if self.a.pre_tokenizer is None or self.a.normalizer is not None:
            return None
        cut = {end for _, (_, end) in self.a.pre_tokenizer.pre_tokenize_str("".join(f" {c}{mark}" for c in sorted(LETTERS)))}
        if not all({3 * i + 2, 3 * i + 3} <= cut for i in range(len(LETTERS))):
            return None
        over = re.compile(f"[{''.join(LETTERS)}]{re.escape(mark)}|{re.escape(mark)}{SPACE}")
        if any(over.search(self.b.id_to_piece(i)) for i in range(self.n_b)):
            return None
        x = align_text(self, "a" + mark)
        if x is None or 2 not in x.cuts:
            return None
        at = int(np.searchsorted(x.cuts, 2))
        low_a, low_b = x.last_a[at] + 1, x.last_b[at] + 1
        own = Aligned(x.a[low_a:], x.b[low_b:], x.cuts[at + 1:], x.last_a[at + 1:] - low_a, x.last_b[at + 1:] - low_b)
        return len(own.a), len(own.b), written(self, own).encode(), _pairs(self, own).tobytes()


@dataclass
class Aligned:
    """Ids of both sides, the byte offsets where both end, and the tokens that end there."""

    a: np.ndarray
    b: np.ndarray
    cuts: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray


def _refined(ends: np.ndarray, exact: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``ends`` where they are exact; else the last exact end (0 before the first) and the
    bytes of the tokens since."""
    if exact.all():
        return ends
    total = np.cumsum(lengths)
    at = np.maximum.accumulate(np.where(exact, np.arange(len(ends)), -1))
    base = np.where(at >= 0, ends[at] - total[at], 0)
    return base + total


def align_text(tools: Tools, text: str | None) -> Aligned | None:
    """None for a null or empty text, and where either side's bytes aren't space and text."""
    if not text:
        return None
    spaced = " " + text
    raw = spaced.encode("utf-8", "surrogatepass")
    coded = tools.a.encode(spaced, add_special_tokens=False)
    ids = coded.ids
    if b"".join([tools.bytes_a[i] for i in ids]) != raw:
        return None
    pieces = list(tools.b.encode(text, return_type="proto").pieces)
    ids_b, ends_b = [p.id for p in pieces], [p.end for p in pieces]
    if b"".join([tools.bytes_b[i] for i in ids_b]) != raw:
        return None
    a, b = np.array(ids, np.int64), np.array(ids_b, np.int64)

    spans = np.fromiter(chain.from_iterable(coded.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
    ends = spans[:, 1]
    exact = np.append(spans[1:, 0] >= ends[:-1], True)
    if len(raw) != len(spaced):  # characters to bytes
        first = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        ends = np.append(first, len(raw))[ends]
    ends_a = _refined(ends, exact, tools.long_a[a])

    ends = np.array(ends_b, np.int64) + 1  # behind the space that B adds
    ends_b = _refined(ends, ends > np.append(0, ends[:-1]), tools.long_b[b])

    at = np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)
    last_a = np.flatnonzero(ends_b[at] == ends_a)
    return Aligned(a, b, ends_a[last_a], last_a, at[last_a])


def written(tools: Tools, x: Aligned) -> str:
    """Groups as text: ids of A, a bar, ids of B; groups parted by semicolons."""
    n_a, n_b = len(x.a), len(x.b)
    ends_a, ends_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    ends_a[x.last_a], ends_b[x.last_b] = 1, 1
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    # Before a token of A stand the tokens of B of earlier groups; before one of B the
    # tokens of A up to its own group.
    before_a = np.append(0, x.last_b + 1)[group_a]
    before_b = (x.last_a + 1)[group_b]
    out = np.empty(n_a + n_b, object)
    out[np.arange(n_a) + before_a] = tools.text_a[x.a + ends_a * tools.n_a]
    out[np.arange(n_b) + before_b] = tools.text_b[x.b + ends_b * tools.n_b]
    return "".join(out.tolist())[:-1]


def _pairs(tools: Tools, x: Aligned) -> np.ndarray:
    return (x.a[x.last_a] * tools.n_b + x.b[x.last_b]).astype("<u4")


def _learn(tools: Tools, units: list[str]) -> None:
    """Align units joined by blanks and cut the result at the blanks. Units that a tokenizer
    changes are found by halves and remembered as None."""
    x = align_text(tools, " ".join(units))
    if x is None:
        if len(units) == 1:
            tools.new[units[0]] = None
        else:
            _learn(tools, units[:len(units) // 2])
            _learn(tools, units[len(units) // 2:])
        return
    raw = np.frombuffer((" " + " ".join(units)).encode("utf-8", "surrogatepass"), np.uint8)
    first = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    ends = first[np.cumsum(np.fromiter(map(len, units), np.int64, len(units)) + 1)]
    at = np.searchsorted(x.cuts, ends)
    if not (x.cuts[np.minimum(at, len(x.cuts) - 1)] == ends).all():
        raise ValueError("a tokenizer joins words across a blank")
    groups, pairs = written(tools, x).encode(), _pairs(tools, x).tobytes()
    stops = np.append(np.flatnonzero(np.frombuffer(groups, np.uint8) == ord(";")), len(groups))[at]
    sizes = np.diff([x.last_a[at], x.last_b[at], at], prepend=-1).T.astype("<u4").tobytes()
    low = low_pair = 0
    for unit, head, stop, pair in zip(units, range(0, len(sizes), _SIZES.size), stops.tolist(), (4 * at + 4).tolist()):
        tools.new[unit] = sizes[head:head + _SIZES.size] + pairs[low_pair:pair] + groups[low:stop]
        low, low_pair = stop + 1, pair


def _units(text: str | None) -> list[str]:
    """The text cut at single blanks between words."""
    if not text:
        return []
    if len(" ".join(text.split())) == len(text):  # blanks of all kinds stand alone, none at the ends
        return text.split(" ")
    return _BETWEEN.split(text)


def _opened(raw: bytes | None, mark: tuple[int, int, bytes, bytes] | None) -> tuple[int, int, bytes, bytes] | None:
    """A unit as remembered, and the mark behind it if there is one."""
    if raw is None:
        return None
    n_a, n_b, n = _SIZES.unpack_from(raw)
    at = _SIZES.size + 4 * n
    if mark is None:
        return n_a, n_b, raw[at:], raw[_SIZES.size:at]
    more_a, more_b, groups, pairs = mark
    return n_a + more_a, n_b + more_b, raw[at:] + b";" + groups, raw[_SIZES.size:at] + pairs


def align_batch(tools: Tools, texts: list[str | None]) -> list[tuple[int, int, str, bytes]]:
    """Tokens of A and B, groups as text and packed pairs of every text; zeros and nothing for one
    without tokens."""
    cut = [_units(t) for t in texts]
    whole = set().union(*cut)
    bare = {u: u[:-1] if u[-1] in tools.marks and u[-2:-1] in LETTERS else u for u in whole}
    met = set(bare.values())
    if 2 * len(tools.units) > REMEMBERED_UNITS:  # what isn't met again is forgotten at the next turn
        tools.units, tools.older = {}, tools.units
    tools.units.update((u, tools.older[u]) for u in met & tools.older.keys())
    again = met & tools.new.keys()
    tools.units.update((u, tools.new.pop(u)) for u in again)
    new = met.difference(tools.units)
    if len(tools.new) + len(new) > NEW_UNITS:
        tools.new = {}
    some, letters = [], 0
    for unit in new:
        if unit != unit.strip():  # at either end of a text: no single blank can stand beside it
            _learn(tools, [unit])
            continue
        some.append(unit)
        letters += len(unit)
        if letters > UNIT_LETTERS:
            _learn(tools, some)
            some, letters = [], 0
    if some:
        _learn(tools, some)
    known = {u: _opened((tools.new if v in new else tools.units)[v], tools.marks[u[-1]] if u is not v else None)
             for u, v in bare.items()}
    changed = None in known.values()
    out = []
    for units in cut:
        found = [known[u] for u in units]
        if not found or changed and None in found:
            out.append((0, 0, "", b""))
            continue
        n_a, n_b, groups, pairs = zip(*found)
        out.append((sum(n_a), sum(n_b), b";".join(groups).decode(), b"".join(pairs)))
    return out


_HELD: dict = {}


def _tools(spec_a, model_b) -> Tools:
    """The worker's tools, kept between tasks of one Python worker."""
    key = (hash(spec_a.value), hash(model_b.value))
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Tools(spec_a.value, model_b.value)
    return _HELD[key]


def alignments(docs: DataFrame, tokenizer_a: str, model_b: str, doc_id: str = "doc_id", text: str = "text",
               spans: bool = False) -> DataFrame:
    """One row per document row: id, ``n_a``, ``n_b``, ``groups`` (text), ``links`` (for each
    group the pair of its last ids, ``a * size of B + b``, packed as 32-bit numbers) and, if
    asked for, ``cuts`` (byte offsets in space and text where groups end).

    Null and empty texts, and texts that either tokenizer changes, have no tokens: zeros, an
    empty text and empty lists. Both files are read on the driver and broadcast; their size
    doesn't depend on the data. Repeated rows are aligned alike; an empty table gives no
    rows. Other columns are not read."""
    spark = docs.sparkSession
    with open(tokenizer_a, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    with open(model_b, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("content"))
    fields = [T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()),
              T.StructField("groups", T.StringType()), T.StructField("links", T.BinaryType())]
    more = [T.StructField("cuts", T.ArrayType(T.LongType()))] if spans else []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tools = _tools(spec, model)
        for pdf in batches:
            texts = pdf["content"].tolist()
            gc.disable()  # a batch makes millions of tuples, none of them in a cycle
            try:
                n_a, n_b, groups, links = zip(*align_batch(tools, texts)) if texts else ((),) * 4
            finally:
                gc.enable()
            made = {"id": pdf["id"], "n_a": np.array(n_a, np.int64), "n_b": np.array(n_b, np.int64),
                    "groups": list(groups), "links": list(links)}
            if spans:
                found = [align_text(tools, t) for t in texts]
                made["cuts"] = [[] if x is None else x.cuts for x in found]
            yield pd.DataFrame(made)

    small_batches(spark, 400, "4m")
    return rows.mapInPandas(run, T.StructType([rows.schema["id"], *fields, *more])).withColumnRenamed("id", doc_id)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n): how often each pair is linked in all rows of ``links`` (packed numbers)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for pdf in batches:
            new, n = np.unique(np.frombuffer(b"".join(pdf["links"]), "<u4").astype(np.int64), return_counts=True)
            keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            sums = np.bincount(at, weights=np.concatenate([sums, n]), minlength=len(keys)).astype(np.int64)
            if len(keys) > FLUSH:
                yield pd.DataFrame({"pair": keys, "n": sums})
                keys, sums = keys[:0], sums[:0]
        yield pd.DataFrame({"pair": keys, "n": sums})

    parts = links.select("links").mapInPandas(count, "pair bigint, n bigint")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"))


def _head(counts: DataFrame) -> pd.DataFrame:
    """The most frequent pairs, HEAD_PAIRS at most: from which count on they fit is told by a
    histogram over eighths of powers of two."""
    level = F.floor(F.log2("n") * 8)
    least, room = 0, HEAD_PAIRS
    for at, n in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # under 512 rows
        room -= n
        if room < 0:
            least = at + 1
            break
    found = counts.where(level >= least).select("pair", "n", "best").toPandas()  # HEAD_PAIRS rows at most
    return found.sort_values("pair")


def count_links(aligned: DataFrame, size_b: int) -> DataFrame:
    """The rows of ``aligned`` (any columns, and ``links`` as made by ``alignments``, which is left
    out) with ``n_links``, ``n_best`` (links whose pair is the most frequent of its B id in all
    rows, ties included) and ``count_sum`` (the count over all rows of each link's pair, added
    up). ``size_b`` is the number of ids of B. ``aligned`` is read twice, so store it first.

    Rows without links have zeros. Repeated rows each count. An empty table gives no rows."""
    spark = aligned.sparkSession
    counts = stored(pair_counts(aligned).select("pair", "n", F.pmod("pair", F.lit(size_b)).alias("b")), "pair-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # at most size_b rows
    counts = counts.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    head = _head(counts)
    sent = spark.sparkContext.broadcast((head["pair"].to_numpy().astype("<u4"), *(head[c].to_numpy() for c in ("n", "best"))))

    @F.pandas_udf("best bigint, total bigint, rest array<bigint>")
    def look_up(links: pd.Series) -> pd.DataFrame:
        pairs, n, best = sent.value
        out = []
        for raw in links:
            own = np.sort(np.frombuffer(raw, "<u4"))  # neighbours are looked up in the same places
            if not len(pairs):
                out.append((0, 0, own.astype(np.int64)))
                continue
            at = np.minimum(np.searchsorted(pairs, own), len(pairs) - 1)
            hit = pairs[at] == own
            out.append((int(best[at[hit]].sum()), int(n[at[hit]].sum()), own[~hit].astype(np.int64)))
        columns = list(zip(*out)) or [(), (), ()]
        return pd.DataFrame({"best": np.array(columns[0], np.int64), "total": np.array(columns[1], np.int64),
                             "rest": list(columns[2])})

    others = [c for c in aligned.columns if c != "links"]
    size = (F.octet_length("links") / 4).cast("bigint").alias("n_links")
    found = aligned.select(*others, size, look_up("links").alias("__x"), F.monotonically_increasing_id().alias("__row"))
    found = stored(found.select(*others, "n_links", "__row", *[
        F.col(f"__x.{c}").alias(f"__{c}") for c in ("best", "total", "rest")]), "pair-lookups")
    rare = (found.select("__row", F.explode("__rest").alias("pair")).join(counts, "pair")
            .groupBy("__row").agg(F.count_if("best").alias("__rare_best"), F.sum("n").alias("__rare_total")))
    none = F.lit(0).cast("bigint")
    return (found.drop("__rest").join(rare, "__row", "left")
            .select(*others, "n_links", (F.col("__best") + F.coalesce("__rare_best", none)).alias("n_best"),
                    (F.col("__total") + F.coalesce("__rare_total", none)).alias("count_sum")))


def pieces(model_b: str) -> int:
    """Number of ids of a sentencepiece model."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=model_b).get_piece_size()
