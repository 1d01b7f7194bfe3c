"""Corpus pipeline: each stage works on all rows that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from panelspark.llm.common import checkpoint_dir
from panelspark.llm.exact_dedup import exact_dedup
from panelspark.llm.jaccard import dedup_near
from panelspark.llm.mixing import mix
from panelspark.llm.packing import pack, tokenise
from panelspark.llm.quality import keep_good


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier does not reject."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without white space."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: five-word shingles, similarity 0.75 or more."""
    return dedup_near(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at temperature weights: every row at least once, none more than twice."""
    return mix(docs, repetition_limit=2.0).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 ids in as few sequences as possible, with their ids."""
    return pack(tokenise(docs, bytes_per_id=2))


STAGES = [
    ("quality classifier", good),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

#: Classifier, permutation and packing are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
