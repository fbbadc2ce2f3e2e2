"""Registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontaminate, exact_dedup, jaccard_join, line_dedup, maxent, prefix_trie, quality,
               secret_scan, simhash, token_align, toxicity, warc)
from .common import shared_dir, stored, table


def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, seed=42)


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{os.urandom(8).hex()}"
    warc.write_pages(table(spark, sf_dir, "pages"), path, min_bytes=0)
    back = warc.read_warc(spark, path)

    def number(urn: str):
        return F.nullif(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1), F.lit("")).cast("bigint")

    return back.select(
        number("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("bigint"), "http_length").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "record_type",
        number("refers_to").alias("refers_to"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path())
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))
    return found.select("doc_id", *[count(k) for k in secret_scan.BASE],
                        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def q_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.lm_scores(table(spark, sf_dir, "documents"))


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", F.col("__removed").alias("n_removed"),
                          F.char_length("text").cast("bigint").alias("n_chars"),
                          F.sha2("text", 256).alias("text_sha256"))


def q_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), shingle=5, percent=80)


def q_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    aligned = stored(token_align.alignments(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                            model), "token-groups", "zstd")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = aligned.select("doc_id", "n_a", "n_b", digest.alias("groups_sha256"), "links")
    found = token_align.count_links(rows, token_align.pieces(model))
    return found.select("doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum",
                        "groups_sha256")


def q_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = prefix_trie.rebuilt_paths(table(spark, sf_dir, "conversations"), every=20, turns=4)
    return prefix_trie.prefix_trie(rebuilt)


def queries() -> dict:
    return {
        "op1_decontamination": q_decontamination,
        "op2_toxicity": q_toxicity,
        "op3_exact_dedup": q_exact_dedup,
        "op4_simhash": q_simhash,
        "op5_warc": q_warc,
        "op6_quality": q_quality,
        "op7_bpe": q_bpe,
        "op8_secrets": q_secrets,
        "op9_lm_scoring": q_lm_scoring,
        "op10_line_dedup": q_line_dedup,
        "op11_jaccard_join": q_jaccard_join,
        "op12_token_alignment": q_token_alignment,
        "op13_prefix_trie": q_prefix_trie,
    }


_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = "regexp_extract_all(" + _FOLD.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATION = f"""
WITH items AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, w[i:i + 9] AS g
         FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT len(g) AS l FROM wins),
docs AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
runs AS (SELECT doc_id, i, l, w[i:i + l - 1] AS g FROM docs, lens, unnest(range(1, len(w) - l + 2)) t(i)),
hits AS (SELECT doc_id, i, l, item_id FROM runs JOIN wins USING (g)),
words AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM hits, unnest(range(0, l)) t(o) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)"""

_EXACT = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS c FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY c) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(c) AS text_sha256
FROM d WINDOW w AS (PARTITION BY c ORDER BY n DESC, doc_id)"""

_LINES = r"""
WITH l AS (SELECT doc_id, source, i, line,
                  regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare
           FROM (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
bad AS (SELECT bare, min(doc_id) AS first_id FROM l WHERE bare <> '' AND source IS NOT NULL
        GROUP BY bare HAVING count(DISTINCT source) >= 10),
marked AS (SELECT l.*, first_id IS NOT NULL AND first_id <> doc_id AS gone FROM l LEFT JOIN bad USING (bare)),
clean AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed,
                 coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS t
          FROM marked GROUP BY doc_id)
SELECT doc_id, n_removed, length(t) AS n_chars, sha256(t) AS text_sha256 FROM clean"""

_CRC32 = """xor(list_reduce(list_transform(range(0, length({0}) + 1), lambda i: CASE WHEN i = 0 THEN 4294967295::BIGINT
                                           ELSE ascii(({0})[i::INT])::BIGINT END),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                             lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

_TRIE = rf"""
WITH t AS (SELECT conv_id, turn, dense_rank() OVER (ORDER BY coalesce(role, ''), coalesce(text, '')) AS id,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
           FROM conversations WHERE conv_id IS NOT NULL),
words AS (SELECT DISTINCT id, w FROM t),
own AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST) AS ids, {_CRC32.format('conv_id::VARCHAR')} % 4 AS h
        FROM t GROUP BY conv_id),
rebuilt AS (SELECT o.conv_id, list_concat(coalesce(b.ids, [])[1:o.h], o.ids[o.h + 1:]) AS ids
            FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
members AS (SELECT conv_id AS c, ids[1:d] AS k, d, d = len(ids) AS ends FROM rebuilt, unnest(range(0, len(ids) + 1)) u(d)),
nodes AS (SELECT k, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ends
          FROM members GROUP BY k, d),
below AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(w, 0) AS saved
               FROM nodes n LEFT JOIN below USING (k) LEFT JOIN words ON words.id = k[len(k)]),
totals AS (SELECT k[1:i] AS k, sum(saved) AS saved_tokens, count_if(n_children = 0) AS n_leaves
           FROM full_nodes, unnest(range(0, depth + 1)) u(i) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves::BIGINT AS n_leaves,
       t.saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN totals t USING (k) LEFT JOIN nodes p ON n.depth > 0 AND p.k = n.k[1:n.depth - 1]"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": _DECONTAMINATION,
        "op3_exact_dedup": _EXACT,
        "op10_line_dedup": _LINES,
        "op13_prefix_trie": _TRIE,
    }
