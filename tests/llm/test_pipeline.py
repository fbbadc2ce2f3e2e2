import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stationflow.llm import queries
from stationflow.llm.common import stored

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        kept = stored(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, kept))
        docs = kept
    return {name: (before, after) for name, before, after in out}


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_all_but_the_last_return_documents(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == COLUMNS and after.schema == before.schema
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}


def test_each_stage_takes_effect_and_keeps_the_rest(stages):
    before, after = (texts(x) for x in stages["toxicity"])
    assert len(before) > len(after) > 0.7 * len(before) and all(before[i] == t for i, t in after.items())
    before, after = (texts(x) for x in stages["line_dedup"])
    assert before.keys() == after.keys()
    before, after = stages["simhash_near_dedup"]
    groups = queries.simhash.simhash_components(before).select("component_id").distinct()
    assert after.count() == groups.count()
    before, after = stages["decontamination"]
    hit = {r.doc_id for r in queries.decontaminate.decontaminate(
        before, queries.table(before.sparkSession, SF, "benchmark")).where("contaminated").collect()}
    assert texts(after).keys() == texts(before).keys() - hit
    before, after = stages["bpe"]
    assert before.count() == after.count() and after.where("n_tokens <> size(split(ids, ' ')) and ids <> ''").count() == 0


def test_run_applies_all_stages(spark, stages):
    key = [F.col("doc_id"), F.col("n_tokens"), F.sha2("ids", 256), F.col("decoded_sha256")]
    assert sorted(corpus_pipeline.run(spark, SF).select(*key).collect()) == sorted(stages["bpe"][1].select(*key).collect())


def test_nulls_repeated_rows_and_empty(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, None, None, None, None), (None, "a b", "en", "s", 3), (2, "", "en", None, 0), (3, "x y z", "en", "s", 5),
            (3, "x y z", "en", "s", 5)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        n = docs.count()
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), "test-edge")
        assert docs.count() == (3 if n else 0)  # the null and the empty text, and the two rows of 3, are one
