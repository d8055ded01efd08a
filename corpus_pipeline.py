"""From raw documents to packed training sequences.

Five stages in order, each a function of (spark, docs, sf_dir) over all that
the one before it kept. All but the last return the columns of ``documents``;
``n_chars`` follows the text.

1. language: documents without a letter, and those of which no language covers
   a third of the words, go.
2. near_dedup: of each near-duplicate group, and of rows repeated in full, one
   document stays (the smallest id).
3. pii: personal data is replaced by labels, disclosing terms by a general
   label or nothing.
4. mix: one row for every copy that the mix takes, in training order; the last
   copy of a source may be cut short.
5. pack: the pieces of all rows in their sequences.

Nulls in any column, empty texts, repeated rows, extra columns and an empty
table pass through with the results that the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.llm.common import written
from cardspark.llm.langid import UND, fitted, identify
from cardspark.llm.minhash import near_duplicates
from cardspark.llm.mixing import training_order
from cardspark.llm.packing import pack
from cardspark.llm.pii import redact

LEAST_SHARE = 1 / 3


def _like(df: DataFrame, docs: DataFrame) -> DataFrame:
    """``df`` with the columns of ``docs``, n_chars made anew."""
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return df.select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    d = identify(docs, fitted(docs))
    return d.filter((F.col("_lang_pred") != UND) & (F.col("_lang_score") >= LEAST_SHARE)) \
        .select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = written(near_duplicates(docs).select("doc_id", "kept"), "dedup_groups")
    gone = groups.filter(~F.col("kept")).select("doc_id")
    again = written(groups.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id")
                    .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "repeated_ids")
    once = docs.join(gone.unionByName(again), "doc_id", "left_anti")
    one_each = docs.join(again, "doc_id", "left_semi").join(gone, "doc_id", "left_anti") \
        .dropDuplicates(["doc_id", "text"])
    return once.unionByName(one_each).select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like(redact(docs), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like(training_order(docs), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mix", mix),
    ("pack", pack_sequences),
]

# Tokenising and the fitted language model are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
