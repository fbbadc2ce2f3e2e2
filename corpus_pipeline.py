"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir), with the columns of ``documents``, and works on all
rows that its predecessor kept. The driver writes each result as Parquet and reads it
again; ``run`` does the same in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from stationflow.llm.common import stored, table
from stationflow.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sites show leave all texts but one; all documents stay.
    ``n_chars`` follows the text."""
    cleaned = line_dedup.line_dedup(docs).drop("__removed")
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.near_dedup(docs, shingle=3, seed=42)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any ten consecutive words of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token ids (decimal, joined by blanks) and the digest of the text
    that they decode to."""
    coded = bpe.encode(docs, tokenizer_path())
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", clean_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

ORACLE_SQL = None  # SQL can't express a trained classifier or a tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
