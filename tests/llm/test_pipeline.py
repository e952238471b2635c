"""The corpus pipeline stage by stage."""

from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm.common import documents, stored

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_columns(spark):
    docs = documents(spark, FOLDER)
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER), f"test-{name}")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    assert docs.select("text").distinct().count() == counts[-1]
    assert docs.where(F.col("text").rlike("AKIA[A-Z0-9]{14}")).isEmpty()
    pieces = corpus_pipeline.packed(spark, docs, FOLDER)
    assert pieces.select("doc_id").distinct().count() == counts[-1]


def test_empty_documents(spark):
    docs = documents(spark, FOLDER).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0
