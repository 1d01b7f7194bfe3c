"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann
from .alignment import align
from .exact_dedup import exact_groups
from .jaccard import near_duplicates
from .langid import identify
from .lm import score_texts
from .mixing import mix
from .packing import pack, tokenise
from .quality import classify
from .repeats import remove_repeats
from .sharding import shard_rows
from .topk import search
from .whitening import whiten


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "n_copies")


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy drawn: document, pass, block, place in the mix, words, weight and draws of its source."""
    mixed = mix(_documents(spark, sf_dir), repetition_limit=2.0)
    return mixed.select(
        "doc_id",
        "source",
        F.col("mix_epoch").alias("epoch"),
        F.col("mix_block").alias("block"),
        F.col("mix_position").alias("position"),
        F.col("mix_words").alias("n_words"),
        F.col("mix_weight").alias("weight"),
        F.col("mix_repetition").alias("repetition"),
    )


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "id % 50 = 0", k=5, scale=256.0)
    return found.select("query_id", "rank", "vec_id", "score")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokenise(_documents(spark, sf_dir), bytes_per_id=0).drop("ids")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_documents(spark, sf_dir))


def op7_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(_documents(spark, sf_dir), shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_documents(spark, sf_dir), digest_all=True).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_documents(spark, sf_dir))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=4, scale=256.0)
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align(_documents(spark, sf_dir))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


def op13_approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "id % 20 = 0", k=20)
    return found.select("query_id", "rank", "vec_id", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard,
        op2_temperature_mixing,
        op3_exact_topk,
        op4_quality_classifier,
        op5_best_fit_packing,
        op6_language_id,
        op7_feistel_sharding,
        op8_exact_dedup,
        op9_suffix_dedup,
        op10_katz_lm,
        op11_embedding_whitening,
        op12_cross_tokenizer_alignment,
        op13_approximate_neighbours,
    )
}

ORACLES: dict[str, str] = {
    "op3_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        )
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5
    """,
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
            FROM documents
        ), r AS (
            SELECT doc_id, sha256(norm) AS text_sha256,
                   count(*) OVER (PARTITION BY norm) AS group_size,
                   first_value(doc_id) OVER w AS keep_id,
                   row_number() OVER w AS place
            FROM d WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)
        )
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
    """,
}
