"""Secret scans with one automaton for all rules.

The rules are compiled on the driver, once, into one minimal deterministic
automaton that tells, after every byte, which rules may end there. Each batch of texts is
one buffer, and one pass over its bytes finds all places where a rule accepts. Around
these few places the spans are settled: the start by the rule's own automaton run
backwards, the end by the longest match from that start.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .automaton import Automaton
from .common import small_batches

#: A byte that no UTF-8 text has; no rule of the table below can cross it.
BREAK = 0xFF
BUFFER_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds spans, leftmost first and as long as possible. A span whose bytes
    beyond the longest match of ``prefix`` are fewer than ``least`` is dropped after it
    has been found, so it still hides what begins inside it."""

    kind: str
    pattern: str
    least: int = 0
    prefix: str = ""


_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
#: The base kinds first, in the order in which spans are listed. Runs of hex
#: digits are everywhere in prose, so their least length is part of the pattern (a run is
#: taken whole either way); the others start with a rare word, and counting in the pattern
#: would only multiply the states.
RULES = (
    Rule("assign", _ASSIGN + r"[A-Za-z0-9+/_.=-]+", 12, _ASSIGN),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("pem", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")


@cache
def _compiled(rules: tuple[Rule, ...]):
    everything = Automaton([r.pattern for r in rules], search=True)
    own = [(Automaton([r.pattern], backwards=True), Automaton([r.pattern]),
            Automaton([r.prefix]) if r.prefix else None) for r in rules]
    return everything, own


def _spans(text: bytes, accepted: list[tuple[int, int]], rules: tuple[Rule, ...], own: list
           ) -> list[tuple[int, int, int]]:
    """(start, end, rule) in bytes, from the (end, rules as bits) where rules accept."""
    found, free = [], [0] * len(rules)
    for end, bits in accepted:
        for r, rule in enumerate(rules):
            if not bits >> r & 1 or end <= free[r]:
                continue
            back, ahead, prefix = own[r]
            size = back.longest(text, free[r], end, back=True)
            if size < 0:
                continue
            start = end - size
            stop = start + ahead.longest(text, start, len(text))
            free[r] = stop
            value = start + (prefix.longest(text, start, stop) if prefix else 0)
            if stop - value >= rule.least:
                found.append((start, stop, r))
    return sorted(found, key=lambda s: (s[0], s[2]))


def scan_texts(texts: list[str | None], rules: tuple[Rule, ...] = RULES, compiled=None) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) in code points, for each text."""
    everything, own = compiled or _compiled(rules)
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    out: list[list[tuple[str, int, int]]] = [[] for _ in raw]
    first = 0
    while first < len(raw):
        last, size = first, 0
        while last < len(raw) and (last == first or size + len(raw[last]) < BUFFER_BYTES):
            size += len(raw[last]) + 1
            last += 1
        block = raw[first:last]
        data = np.frombuffer(bytes([BREAK]).join(block) + bytes([BREAK]), np.uint8)
        bits = everything.accepts[everything.scan(data)]
        ends = np.cumsum([len(b) + 1 for b in block])
        hits = np.nonzero(bits)[0]
        owner = np.searchsorted(ends, hits, side="right")
        for k in np.unique(owner).tolist():
            mine = hits[owner == k]
            begin = int(ends[k]) - len(block[k]) - 1
            accepted = [(int(h) - begin + 1, int(bits[h])) for h in mine]
            text = block[k]
            is_ascii = text.isascii()
            for start, end, r in _spans(text, accepted, rules, own):
                if not is_ascii:
                    start, end = (len(text[:p].decode("utf-8", "surrogatepass")) for p in (start, end))
                out[first + k].append((rules[r].kind, start, end))
        first = last
    return out


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row: id and ``spans``, an array of (kind, start, end) in code points, end
    exclusive, by start and then by the order of the rules.

    Spans of one kind don't overlap; those of different kinds may. A null or empty text
    has none. Whole texts are scanned, however long. Repeated rows get equal spans; an
    empty table gives no rows. Other columns are not read."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("content"))
    compiled = spark.sparkContext.broadcast(_compiled(rules))  # as large as the rules make it
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                     T.StructField("end", T.LongType())]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            spans = scan_texts(pdf["content"].tolist(), rules, compiled.value)
            yield pd.DataFrame({"id": pdf["id"], "spans": [
                [{"kind": k, "start": a, "end": z} for k, a, z in s] for s in spans]})

    small_batches(spark)
    return rows.mapInPandas(run, T.StructType([rows.schema["id"], T.StructField("spans", span)])
                            ).withColumnRenamed("id", doc_id)
