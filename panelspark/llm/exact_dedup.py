"""Exact deduplication by progressive refinement: length, prefix hash, full hash.

DataFrame functions only. Texts are equal when identical after deleting
every separator character; null counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SEPARATOR_CLASS, pick, scratch, with_totals


def normalised(text: Column) -> Column:
    """The text without separator characters; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SEPARATOR_CLASS}+", "")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64, digest_all: bool = False
) -> DataFrame:
    """Every row with its group of equal texts and whether it is the one that stays.

    Returns (doc_id, row_key, keep_id, group_size, kept, digest), one row per
    input row. Of equal texts the row with the most code points in the
    original text stays, then the smallest id (null ids last); of rows equal
    in these too, exactly one. ``row_key`` hashes id and original text.

    Three refinements, each only over the survivors of the one before:
    normalised length; hash of the first ``prefix_chars`` normalised
    characters; SHA-256 of the whole normalised text. Only rows whose length
    and prefix both occur again are read in full. ``digest_all`` is for
    callers who want the SHA-256 of every row anyway: it is then taken in the
    first read and no second one is made; otherwise ``digest`` is null where
    no full read was needed. Empty and null texts form one group. An empty
    table gives an empty result.
    """
    rows = pick(docs, id=id_col, text=text_col)
    norm = normalised(F.col("text"))
    key = F.xxhash64(F.col("id"), F.col("text"))
    first = rows.select(
        "id",
        key.alias("row_key"),
        F.monotonically_increasing_id().alias("uid"),
        F.coalesce(F.length("text"), F.lit(0)).alias("chars"),
        F.length(norm).alias("len"),
        F.xxhash64(F.substring(norm, 1, prefix_chars)).alias("prefix"),
        (F.sha2(norm, 256) if digest_all else F.lit(None).cast("string")).alias("digest"),
    )
    slim = scratch(first, "dedup-slim")
    count = {"n": (F.count(F.lit(1)), "sum")}

    by_len = with_totals(slim, ["len"], count, ["uid"])
    alive = by_len.filter("n > 1").drop("n")
    by_prefix = with_totals(scratch(alive, "dedup-len"), ["len", "prefix"], count, ["uid"])
    alive = by_prefix.filter("n > 1").drop("n")
    if not digest_all:
        alive = scratch(alive, "dedup-prefix")
        full = (
            rows.withColumn("row_key", key)
            .join(alive.select("row_key").distinct(), "row_key", "left_semi")
            .select("id", "row_key", F.sha2(norm, 256).alias("digest"))
            .distinct()
        )
        alive = alive.drop("digest").join(full, (alive.row_key == full.row_key) & alive.id.eqNullSafe(full.id)).select(
            alive.id, alive.row_key, "uid", "chars", "len", "prefix", "digest"
        )
    best = F.min(F.struct(-F.col("chars"), F.col("id").isNull(), F.col("id"), F.col("uid")))
    groups = with_totals(scratch(alive, "dedup-full"), ["len", "digest"], {"n": count["n"], "best": (best, "min")}, ["uid"])
    grouped = groups.select(
        "uid",
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("best.uid") == F.col("uid")).alias("kept"),
        F.col("digest").alias("full_digest"),
    )
    return slim.join(grouped, "uid", "left").select(
        F.col("id").alias("doc_id"),
        "row_key",
        F.when(F.col("kept").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
        F.coalesce("digest", "full_digest").alias("digest"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows equal in id and text stay once."""
    names = docs.columns
    kept = exact_groups(docs, id_col, text_col, prefix_chars).filter("kept").select(F.col("doc_id").alias("_id"), "row_key").distinct()
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    i, t = F.col(f"_c{names.index(id_col)}"), F.col(f"_c{names.index(text_col)}")
    rows = plain.withColumn("row_key", F.xxhash64(i, t))
    hit = rows.join(kept, (rows.row_key == kept.row_key) & i.eqNullSafe(kept["_id"]), "left_semi")
    return hit.dropDuplicates([f"_c{names.index(id_col)}", "row_key"]).drop("row_key").toDF(*names)
