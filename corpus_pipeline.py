"""The corpus pipeline: toxic documents go, then copies, then near copies; the rest is mixed and packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents. A stage's decisions follow from all documents it
is given; the toxicity model is learned from the labelled ones among them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changemill.llm import curve_packing, exact_dedup, jaccard_join, mixing, toxicity
from changemill.llm.common import scratch, table
from changemill.llm.queries import tokenizer_path

#: A learned lexicon and a tokenizer have no form in SQL; tests compare with brute force.
ORACLE_SQL = None


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not scored as toxic."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return exact_dedup.drop_exact(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents, the one with the smallest doc_id."""
    return jaccard_join.drop_near(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.take_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences."""
    return curve_packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", clean), ("exact_dedup", exact), ("jaccard_join", near), ("mixing", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows are returned unwritten."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = scratch(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
