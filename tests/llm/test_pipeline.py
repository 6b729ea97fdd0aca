"""The pipeline: stage contracts, and the relational stages against brute force."""

import pytest

import corpus_pipeline
from newsflow.llm import ngram_join, storage

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{DIR}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        docs = storage.materialize(f(spark, docs, DIR), name)
        out.append(docs)
    return out


def test_stages(spark, stages):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    assert all(s.columns == docs.columns for s in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "decontamination", "sentencepiece"]
    counts = [docs.count(), *(s.count() for s in stages)]
    assert counts == sorted(counts, reverse=True) and counts[1] >= 0.98 * counts[0] and counts[1] == counts[2] and counts[4] == counts[5]
    assert stages[-1].where("not round_trip").count() == 0


def test_ngram_stage_by_brute_force(stages):
    from test_dedup import brute_components, shingles

    sets = {r.doc_id: shingles(r.text, 5) for r in stages[1].collect()}
    want = {i for i, c in brute_components(sets, 80, 100).items() if i == c}
    assert {r.doc_id for r in stages[2].collect()} == want


def test_decontamination_stage(spark, stages):
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    left = [" ".join(r.text.lower().split()) for r in stages[3].collect()]
    assert not any(i in t for t in left for i in items)


def test_run(spark, stages):
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, DIR).collect()) == sorted(r.doc_id for r in stages[-1].collect())


def test_empty_table(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for name, f in corpus_pipeline.STAGES:
        docs = storage.materialize(f(spark, docs, DIR), name)
        assert docs.count() == 0
    assert ngram_join.Rule(5, 80, 100).boundary({}) == 0
