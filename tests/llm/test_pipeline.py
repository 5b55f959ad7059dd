"""The pipeline: every stage on awkward documents, and the whole on the given ones."""

import corpus_pipeline
from tests.llm import corpus


def test_stages_on_odd_documents(spark, tmp_path):
    rows = corpus.odd_documents()
    place = corpus.written(spark, tmp_path, rows, [(1, 1, 0), (9, 1, 1), (10, 1, 0)])
    docs = spark.read.parquet(f"{place}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, place)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema], name
        out.write.parquet(f"{tmp_path}/stage{i}")
        docs = spark.read.parquet(f"{tmp_path}/stage{i}")
    assert docs.count() > 0
    assert docs.agg({"length": "max"}).first()[0] <= 2048


def test_stages_on_empty_tables(spark, tmp_path):
    place = corpus.written(spark, tmp_path, [])
    docs = spark.read.parquet(f"{place}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, place).count() == 0


def test_run_keeps_clean_documents_and_drops_toxic_and_copies(spark, folder):
    rows = corpus_pipeline.run(spark, folder).select("doc_id").distinct().collect()
    kept = {r["doc_id"] for r in rows}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    texts = corpus.given(folder)
    clean = [i for i, _, _ in texts if labels.get(i) == 0]
    toxic = [i for i, _, _ in texts if labels.get(i) == 1]
    assert sum(i in kept for i in clean) >= 0.9 * len(clean)
    assert sum(i in kept for i in toxic) <= 0.2 * len(toxic)
    seen = {}
    for i, text, _ in texts:
        if i in kept:
            assert seen.setdefault(text, i) == i
