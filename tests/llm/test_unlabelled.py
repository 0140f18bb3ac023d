"""Language ID as a stage where nothing can be learned from."""

import corpus_pipeline as cp
from geoloom.llm import langid


def test_documents_stay_without_labels(spark):
    docs = spark.createDataFrame([(1, "der die das", None), (2, "12 !! ½", None), (3, None, None), (4, "été", None)], "doc_id long, text string, lang string")
    assert sorted(tuple(r) for r in cp.language_id(spark, docs, "").collect()) == [(1, "der die das", None), (4, "été", None)]


def test_documents_stay_where_only_held_out_rows_have_labels(spark):
    ids = spark.range(40).withColumnRenamed("id", "doc_id")
    out = [r.doc_id for r in ids.where(langid.held_out()).collect()]
    docs = spark.createDataFrame([(d, "the and of", "en" if d in out else None) for d in range(40)], "doc_id long, text string, lang string")
    assert out and {(r.doc_id, r.lang) for r in cp.language_id(spark, docs, "").collect()} == {(d, "en" if d in out else None) for d in range(40)}
