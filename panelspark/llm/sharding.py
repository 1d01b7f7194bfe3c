"""Reproducible sharding: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, scratch

ROUNDS = 6


def _mix(v: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def _walk(x: np.ndarray, n: int, seed: int, forward: bool) -> np.ndarray:
    rows = isqrt(max(n - 1, 0)) + 1
    cols = -(-n // rows)
    a, b = np.uint64(rows), np.uint64(cols)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed % 2**64))
    out = np.asarray(x).astype(np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] // b, out[todo] % b
        for k in range(ROUNDS) if forward else reversed(range(ROUNDS)):
            if k % 2 == 0:
                step = _mix(right + keys[k]) % a
                left = (left + (step if forward else a - step)) % a
            else:
                step = _mix(left + keys[k]) % b
                right = (right + (step if forward else b - step)) % b
        out[todo] = left * b + right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def permute(row: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Place of each row number in a pseudo-random permutation of 0..n-1.

    A Feistel network over a grid of at least n cells (and fewer than
    n + sqrt(n) + 1) permutes the grid; a row that lands outside 0..n-1
    walks on along its cycle until it is inside.
    """
    return _walk(row, n, seed, True)


def row_at(place: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """The row number at a place: the inverse of :func:`permute`."""
    return _walk(place, n, seed, False)


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with a shard and a slot, by the law ``rows``: counts at most one apart.

    Rows are numbered globally by (id, text checksum, size), null ids first;
    the permuted number p gives shard p mod ``shards`` and slot p div
    ``shards``, so both follow from (row number, n, seed) alone, and
    :func:`row_at` goes back from shard and slot to the row. Rows equal in
    all three share a set of places. Null texts count as empty. An empty
    table gives an empty result. Returns (doc_id, row_number, size,
    text_crc32, shard, slot).

    Numbers need one range shuffle of narrow rows; the driver sees only one
    count per partition.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = scratch(
        pick(docs, id=id_col, text=text_col).select(
            "id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.monotonically_increasing_id().alias("uid"),  # spreads rows that are equal in all else
        ),
        "shard-rows",
    )
    order = ["id", "crc", "size", "uid"]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = scratch(ranged.select("id", "size", "crc", F.spark_partition_id().alias("part"), inside.alias("pos")), "shard-order")
    counts = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), total, seed))

    offsets = docs.sparkSession.createDataFrame(starts, "part int, start long")  # a row for each partition
    numbered = placed.join(F.broadcast(offsets), "part").withColumn("row_number", F.col("start") + F.col("pos"))
    return numbered.withColumn("place", place("row_number")).select(
        F.col("id").alias("doc_id"),
        "row_number",
        "size",
        F.col("crc").alias("text_crc32"),
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"),
    )
