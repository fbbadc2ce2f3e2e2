import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """texts (or (id, text) or (id, text, source)) -> documents, with columns whose names clash
    with those of results and of steps."""
    def make(rows, clashing=True):
        full = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            doc_id, text, source = r if len(r) == 3 else (*r, f"s{i % 3}")
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        df = spark.createDataFrame(full, SCHEMA)
        if clashing:
            for name in ("id", "score", "kept", "words", "content", "digest", "fp", "site", "item_id", "key", "token"):
                df = df.withColumn(name, F.lit("clash"))
        return df
    return make


@pytest.fixture
def prose():
    """Deterministic texts of random words in two alphabets."""
    r = random.Random(5)
    letters = ["ab", "the", "of", "réé", "ünd", "Zq", "con", "x", "lorem", "ipsum", "dolor", "9"]
    vocabulary = ["".join(r.choices(letters, k=r.randint(1, 3))) for _ in range(400)]

    def make(n, low=1, high=80):
        return [" ".join(r.choices(vocabulary, k=r.randint(low, high))) for _ in range(n)]
    return make


LONG = "word " * 30_000


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
