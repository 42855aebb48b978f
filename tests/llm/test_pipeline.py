"""The pipeline: what each stage keeps, and that all runs together."""

import corpus_pipeline

from .conftest import CLASHES
from .test_near_copies import brute


def test_stages(spark, sf_dir, documents, labels):
    docs = documents
    toxic = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes, name
        rows = out.collect()
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert {r["doc_id"] for r in rows} <= set(before) and len(rows) == len({r["doc_id"] for r in rows})
        if name == "near_duplicates":
            assert {r["doc_id"] for r in rows} == brute(list(before.items()))
        if name == "secrets":
            assert len(rows) == len(before)
        if name == "toxicity":
            assert len(toxic & {r["doc_id"] for r in rows}) < len(toxic)
        docs = spark.createDataFrame(rows, docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in docs.collect()}


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)


def test_messy(spark, messy, no_docs, sf_dir):
    for df in (messy, no_docs):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.dtypes == df.dtypes
            for r in docs.select(*[f"`{c}`" for c in CLASHES]).collect():
                assert list(r) == list(range(len(CLASHES)))
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
