"""Exact top-k search by inner product with block-at-a-time pruning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, scratch

BLOCK_ROWS = 128
#: Queries and rows that meet in a group, about (of 64 dimensions: 4 and 32 MB).
QUERIES_AT_ONCE = 8192
ROWS_AT_ONCE = 65536
#: Products summed below this are exact in doubles.
_EXACT = 2**53
_NONE = np.iinfo(np.int64).min + 1  # its negative is a number too


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, v array<bigint>) of the rows that take part."""
    rows = pick(vectors, id=id_col, raw=vector_col).withColumn("raw", F.col("raw").cast("array<double>"))
    sound = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.filter(F.col("id").isNotNull() & F.col("raw").isNotNull()).filter(sound)
    return kept.select("id", F.transform("raw", lambda x: F.floor(x * F.lit(float(scale))).cast("bigint")).alias("v"))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T as int64, exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < _EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class BlockSearch:
    """The k best of the rows seen so far for a block of queries of one dimension."""

    def __init__(self, uids: np.ndarray, queries: np.ndarray, k: int):
        self.uids, self.queries, self.k = uids, queries, k
        self.above, self.below = np.maximum(queries, 0), np.minimum(queries, 0)
        shape = (len(uids), k)
        self.scores = np.full(shape, _NONE)
        self.ids = np.full(shape, np.iinfo(np.int64).max)
        self.rows = np.full(shape, -1, dtype=np.int64)

    def add(self, ids: np.ndarray, uids: np.ndarray, vectors: np.ndarray) -> None:
        """Blocks of consecutive rows, the most promising first for each query.

        A block's bound sums, over the dimensions, the query's weight times
        the block's largest (for a negative weight: smallest) value. A query
        is done when its next bound is below its kth score; at equality a
        smaller id could still win.
        """
        starts = np.arange(0, len(ids), BLOCK_ROWS)
        most = np.maximum.reduceat(vectors, starts, axis=0)
        least = np.minimum.reduceat(vectors, starts, axis=0)
        bounds = _products(self.above, most) + _products(self.below, least)
        order = np.argsort(-bounds, axis=1, kind="stable")
        active = np.arange(len(self.uids))
        for r in range(len(starts)):
            block = order[active, r]
            going = bounds[active, block] >= self.scores[active, -1]
            active, block = active[going], block[going]
            if not len(active):
                return
            by_block = np.argsort(block, kind="stable")
            for mine in np.split(active[by_block], np.flatnonzero(np.diff(block[by_block])) + 1):
                lo = int(starts[order[mine[0], r]])
                hi = min(lo + BLOCK_ROWS, len(ids))
                self._merge(mine, ids[lo:hi], uids[lo:hi], vectors[lo:hi])

    def _merge(self, mine: np.ndarray, ids: np.ndarray, uids: np.ndarray, vectors: np.ndarray) -> None:
        new = _products(self.queries[mine], vectors)
        own = uids[None, :] == self.uids[mine][:, None]
        hit = ((new >= self.scores[mine, -1][:, None]) & ~own).any(axis=1)
        mine, new, own = mine[hit], new[hit], own[hit]
        if not len(mine):
            return
        scores = np.concatenate([self.scores[mine], np.where(own, _NONE, new)], axis=1)
        wide = (len(mine), len(ids))
        all_ids = np.concatenate([self.ids[mine], np.where(own, np.iinfo(np.int64).max, np.broadcast_to(ids, wide))], axis=1)
        rows = np.concatenate([self.rows[mine], np.where(own, -1, np.broadcast_to(uids, wide))], axis=1)
        best = np.lexsort((all_ids, -scores), axis=1)[:, : self.k]
        for name, values in (("scores", scores), ("ids", all_ids), ("rows", rows)):
            getattr(self, name)[mine] = np.take_along_axis(values, best, axis=1)


def _by_dimension(rows: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, uids, vectors) of the rows of (id, v, uid) for each dimension, in the order of ids."""
    out = {}
    rows = rows.combine_chunks()
    ids, uids = rows.column("id").to_numpy(), rows.column("uid").to_numpy()
    lists = rows.column("v").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], type=lists.type)
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    size = np.diff(offsets)
    for d in set(size.tolist()):
        at = np.flatnonzero(size == d)
        at = at[np.lexsort((uids[at], ids[at]))]
        out[d] = ids[at], uids[at], values[offsets[at][:, None] + np.arange(d)[None, :]].reshape(len(at), d)
    return out


def search(vectors: DataFrame, queries: str, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows with the highest inner product for each query, ties to the smaller id.

    ``queries`` is an SQL condition on ``id``. Components are quantised to
    floor(``scale`` * x). Candidates are all rows but the query's own row (a
    repeated row is a candidate); fewer than k candidates give fewer rows.
    Rows whose id or vector is null, or whose vector has a null or
    non-finite component, take no part; vectors of different dimensions are
    not compared. Two query rows with one id give two results under it.
    Scores must fit 64 bits. Returns (query_id, rank, vec_id, score,
    query_row, vec_row).

    Rows are stored in ranges of the id of about ``ROWS_AT_ONCE`` rows,
    queries in parts of about ``QUERIES_AT_ONCE``. Every part meets every
    range in a group of its own, which searches the range block by block;
    no vector passes through the driver.
    """
    rows = scratch(quantised(vectors, id_col, vector_col, scale).withColumn("uid", F.monotonically_increasing_id()), "topk-rows")
    n = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.expr(queries)).alias("queries")).first()
    ranges, parts = (max(1, -(-n[c] // size)) for c, size in (("rows", ROWS_AT_ONCE), ("queries", QUERIES_AT_ONCE)))
    ordered = rows.repartitionByRange(ranges, "id", F.xxhash64("v"), "uid").withColumn("range", F.spark_partition_id())
    stored = scratch(ordered.select(F.col("id").cast("long"), "v", "uid", "range"), "topk-ranges")
    part = F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("int").alias("part")
    asked = scratch(rows.filter(queries).select(F.col("id").cast("long"), "v", "uid", part), "topk-queries")
    names = ["query_row", "query_id", "vec_id", "vec_row", "score"]

    def searched(mine: pa.Table, against: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[np.zeros(0, dtype=np.int64)] for _ in names]
        candidates = _by_dimension(against)
        for d, (own, uids, matrix) in _by_dimension(mine).items():
            if d in candidates:
                s = BlockSearch(uids, matrix, k)
                s.add(*candidates[d])
                q, j = np.nonzero(s.rows >= 0)
                for column, values in zip(found, (uids[q], own[q], s.ids[q, j], s.rows[q, j], s.scores[q, j])):
                    column.append(values)
        return pa.table([pa.array(np.concatenate(c)) for c in found], names=names)

    to_ranges = asked.withColumn("range", F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))))
    to_parts = stored.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    schema = ", ".join(f"{c} long" for c in names)
    found = to_ranges.groupBy("range", "part").cogroup(to_parts.groupBy("range", "part")).applyInArrow(searched, schema)
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "vec_row"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "query_row", "vec_row")
