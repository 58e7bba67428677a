"""A corpus from raw documents: good ones, one of each kind, without repeated passages and test items, packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firmbook.llm import decontamination, jaccard, packing, quality, substrings
from firmbook.llm.shared import settle, workspace


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_only(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def fresh_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(docs)


def unseen_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", distinct_documents),
    ("substring dedup", fresh_passages),
    ("benchmark decontamination", unseen_documents),
    ("best-fit packing", packed_sequences),
]

#: SQL can express neither the trained classifier nor best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared folder and read again."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), workspace(spark)
    for number, (_, stage) in enumerate(STAGES):
        docs = settle(stage(spark, docs, sf_dir), folder, f"stage-{number}")
    return docs
