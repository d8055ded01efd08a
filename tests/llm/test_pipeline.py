import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp


def step(spark, docs, name):
    return dict(cp.STAGES)[name](spark, docs, "unused")


def test_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["language", "near_dedup", "pii", "mix", "pack"]


@pytest.mark.parametrize("name", ["language", "near_dedup", "pii", "mix"])
def test_columns_and_empty_tables(spark, messy, no_docs, name):
    assert step(spark, messy, name).schema.names == messy.columns
    assert step(spark, no_docs, name).count() == 0


def test_language_rejects_what_has_none(spark, messy):
    kept = {r["doc_id"] for r in step(spark, messy, "language").collect()}
    assert {3, 4, 5}.isdisjoint(kept) and {1, 2, 6, 7, 9} <= kept


def test_one_document_of_each_group_stays(spark, messy):
    out = step(spark, messy, "near_dedup").collect()
    ids = [r["doc_id"] for r in out]
    assert ids.count(1) == 1 and 2 not in ids and 7 not in ids
    assert {3, 4, 5, 6, 100} <= set(ids) and ids.count(None) == 2


def test_run_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    out = cp.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert out.count() > 0
    assert out.join(docs, "doc_id", "left_anti").count() == 0
    overfull = out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048")
    assert overfull.count() == 0
    # every copy that the mix made is packed whole
    whole = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d"))
    assert whole.filter("n < d").count() == 0
