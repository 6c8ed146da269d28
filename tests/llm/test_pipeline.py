"""The stages of the corpus pipeline, one after the other."""

import corpus_pipeline
from playmart.llm.common import materialise


def test_stages_keep_columns_and_take_effect(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == before
