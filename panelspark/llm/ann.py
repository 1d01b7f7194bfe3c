"""Approximate nearest neighbours by learned partitions: a balanced partition of a neighbour graph and a router trained on it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, scratch

#: The model is fitted on this many distinct vectors for each part, and no more than MAX_FIT (and FIT_BYTES as doubles).
FIT_PER_PART = 128
MAX_FIT = 32_768
FIT_BYTES = 1 << 28
MAX_PARTS = 512
#: Neighbours of a row in the graph.
GRAPH_DEGREE = 16
#: How far the size of a part of the graph may be from the mean.
SLACK = 0.1
SWEEPS = 30
HIDDEN = 128
EPOCHS = 12
#: Queries whose true neighbours set how many parts are probed.
CALIBRATION = 256
#: Bytes of vectors that a task of the search holds of either side.
UNIT_BYTES = 1 << 25
#: Units that the index has at least, for parallel tasks.
LEAST_UNITS = 16
SEED = 7


def sound_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>) of the rows that take part: id not null, vector without null or non-finite components and not zero."""
    rows = pick(vectors, id=id_col, raw=vector_col).withColumn("v", F.col("raw").cast("array<double>"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(finite & F.exists("v", lambda c: c != 0))
    return kept.select(F.col("id").cast("long").alias("id"), "v")


def as_matrix(column: pa.Array, d: int) -> np.ndarray:
    """Vectors of a batch as rows; another dimension raises."""
    offsets = column.offsets.to_numpy()
    if len(offsets) and (np.diff(offsets) != d).any():
        raise ValueError(f"vectors must all have {d} dimensions")
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].reshape(-1, d)


def from_bytes(column: pa.ChunkedArray, d: int) -> np.ndarray:
    rows = [np.frombuffer(x.as_py(), dtype=np.float64) for x in column]
    return np.concatenate(rows).reshape(-1, d) if rows else np.zeros((0, d))


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """The ``degree`` other rows with the largest inner product, for each row; in blocks of 256 rows."""
    n = len(x)
    degree = min(degree, n - 1)
    out = np.empty((n, degree), dtype=np.int64)
    for lo in range(0, n, 256):
        s = x[lo : lo + 256] @ x.T
        s[np.arange(len(s)), lo + np.arange(len(s))] = -np.inf
        out[lo : lo + 256] = np.argpartition(-s, degree - 1, axis=1)[:, :degree] if degree else 0
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """A part for each row such that few edges of the graph are cut and sizes stay within ``SLACK`` of the mean.

    Starts from recursive halving along the widest direction; then rows
    move, the largest gain in uncut edges first, to the part of most of
    their neighbours while the sizes allow it, until no move is left.
    """
    n = len(x)
    part = np.zeros(n, dtype=np.int64)
    todo = [(np.arange(n), 0, parts)]
    while todo:
        rows, first, count = todo.pop()
        if count == 1:
            part[rows] = first
            continue
        centred = x[rows] - x[rows].mean(axis=0) if len(rows) else x[rows]
        widest = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = rows[np.argsort(centred @ widest, kind="stable")]
        half = count // 2
        cut = len(rows) * half // count
        todo += [(order[:cut], first, half), (order[cut:], first + half, count - half)]
    rng = np.random.default_rng(SEED)
    source, target = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    ends, others = np.concatenate([source, target]), np.concatenate([target, source])
    most, least = int(np.ceil((1 + SLACK) * n / parts)), int((1 - SLACK) * n / parts)
    sizes = np.bincount(part, minlength=parts)
    for _ in range(SWEEPS):
        near = np.bincount(ends * parts + part[others], minlength=n * parts).reshape(n, parts)
        best = near.argmax(axis=1)
        gain = near[np.arange(n), best] - near[np.arange(n), part]
        movers = np.flatnonzero((gain > 0) & (rng.random(n) < 0.6))  # not all at once: neighbours must not swap for ever
        moved = 0
        for i in movers[np.argsort(-gain[movers], kind="stable")].tolist():
            a, b = part[i], best[i]
            if sizes[b] < most and sizes[a] > least:
                sizes[a] -= 1
                sizes[b] += 1
                part[i] = b
                moved += 1
        if not moved:
            break
    return part


class Router:
    """A network with one hidden layer: the probability that a vector's neighbours are in each part."""

    def __init__(self, x: np.ndarray, targets: np.ndarray):
        rng = np.random.default_rng(SEED)
        d, parts = x.shape[1], targets.shape[1]
        self.scale = np.sqrt(d / max(float((x * x).sum(axis=1).mean()), 1e-300))
        hidden = min(HIDDEN, max(8, 2 * parts))
        self.weights = [rng.normal(size=(d, hidden)) * np.sqrt(2 / d), np.zeros(hidden), rng.normal(size=(hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts)]
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(x))
            rate = 2e-3 * (1 - epoch / EPOCHS)
            for lo in range(0, len(x), 256):
                rows = order[lo : lo + 256]
                z, h, p = self._forward(x[rows])
                g = (p - targets[rows]) / len(rows)
                back = (g @ self.weights[2].T) * (h > 0)
                step += 1
                for w, m, v, grad in zip(self.weights, first, second, (z.T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0))):
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad * grad - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = x * self.scale
        h = np.maximum(z @ self.weights[0] + self.weights[1], 0)
        s = h @ self.weights[2] + self.weights[3]
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return z, h, e / e.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x)[2]

    def part(self, x: np.ndarray) -> np.ndarray:
        """The most probable part of each vector."""
        return self.probabilities(x).argmax(axis=1) if len(x) else np.zeros(0, dtype=np.int64)

    def mass_before(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parts, the most probable first, probability of all parts before each)."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        sorted_p = np.take_along_axis(p, order, axis=1)
        return order, np.cumsum(sorted_p, axis=1) - sorted_p


def fit_router(x: np.ndarray, parts: int) -> Router:
    """The router for ``parts`` parts of the neighbour graph of the sample ``x``."""
    if parts == 1 or len(x) < 2:
        return Router(x, np.ones((len(x), 1)))
    graph = neighbour_graph(x, GRAPH_DEGREE)
    part = balanced_parts(x, graph, parts)
    n, degree = graph.shape
    near = np.bincount(np.repeat(np.arange(n), degree) * parts + part[graph.ravel()], minlength=n * parts).reshape(n, parts)
    targets = 0.8 * near / degree
    targets[np.arange(n), part] += 0.2
    return Router(x, targets)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed from the first dimension to the last, so that equal vectors score alike everywhere."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


class Best:
    """The k best candidates of each query so far: score falling, then id, then row."""

    def __init__(self, queries: np.ndarray, uids: np.ndarray, k: int):
        self.queries, self.uids, self.k = queries, uids, k
        self.size = np.linalg.norm(queries, axis=1)
        self.kth = np.full(len(queries), -np.inf)
        self.found = [np.zeros(0, dtype=t) for t in (np.int64, np.float64, np.int64, np.int64, np.int64)]  # query, score, id, uid, tag

    def add(self, mine: np.ndarray, ids: np.ndarray, uids: np.ndarray, tags: np.ndarray, vectors: np.ndarray) -> None:
        """Lets the queries at ``mine`` see these rows."""
        size = float(np.linalg.norm(vectors, axis=1).max(initial=0.0))
        at_once = max(1, (1 << 21) // max(1, len(ids)))
        new = [self.found]
        for lo in range(0, len(mine) if len(ids) else 0, at_once):
            q = mine[lo : lo + at_once]
            s = self.queries[q] @ vectors.T
            s[uids[None, :] == self.uids[q][:, None]] = -np.inf
            bar = self.kth[q]
            if len(ids) > self.k:
                bar = np.maximum(bar, np.partition(s, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
            # blocks of another shape may round otherwise: what is near the bar is kept, and scored anew
            i, j = np.nonzero((s >= (bar - 1e-12 * self.size[q] * size)[:, None]) & (s > -np.inf))
            new.append([q[i], exact_products(self.queries[q[i]], vectors[j]), ids[j], uids[j], tags[j]])
        query, score, id_, uid, tag = (np.concatenate(x) for x in zip(*new))
        order = np.lexsort((uid, id_, -score, query))
        ordered = query[order]
        place = np.arange(len(order)) - np.searchsorted(ordered, ordered, side="left")
        kept = order[place < self.k]
        self.found = [x[kept] for x in (query, score, id_, uid, tag)]
        last = order[place == self.k - 1]
        self.kth[query[last]] = score[last]


def _stored_matrix(rows: DataFrame) -> np.ndarray:
    """A bounded frame's column v on the driver."""
    return np.array(rows.select("v").toArrow().column("v").to_pylist(), dtype=np.float64)


def search(vectors: DataFrame, queries: str, k: int = 20, target: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows found for each query, by inner product: (query_id, rank, vec_id, score, query_row, vec_row).

    ``queries`` is an SQL condition on ``id``. Candidates are all rows but
    the query's own (a repeated row is a candidate); ties go to the smaller
    id; fewer candidates than ``k`` give fewer rows. Scores are exact inner
    products of the original vectors in double precision. Rows whose id is
    null, or whose vector is null, empty, zero or holds a null or non-finite
    component, take no part; an empty table gives an empty result. Vectors
    of different dimensions raise. Two query rows with one id give two
    results under it. Columns other than the two named are ignored.

    About sqrt(rows) / 4 parts, ``MAX_PARTS`` at most, are learned from a sample
    of ``FIT_PER_PART`` distinct vectors a part (``MAX_FIT`` at most, those of least
    hash). All rows are then indexed under their most probable part, except
    that of equal vectors those beyond the ``k`` + 1 smallest ids are left
    out: no result can hold them. A query probes its most probable parts up
    to a mass of probability, the least at which ``CALIBRATION`` of the queries
    find the share ``target`` of their true neighbours among all rows. A part
    larger than a unit (``UNIT_BYTES``) is spread over several by a hash of the row.
    """
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double, query_row long, vec_row long"
    rows = scratch(sound_vectors(vectors, id_col, vector_col).withColumn("uid", F.monotonically_increasing_id()), "ann-rows")
    asked = rows.filter(queries)
    first = asked.select(F.size("v")).head()
    if first is None:
        return spark.createDataFrame([], out)
    d = first[0]
    order = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id", "uid")
    kept = scratch(rows.withColumn("copy", F.row_number().over(order)).filter(F.col("copy") <= k + 1), "ann-kept")
    distinct, total = kept.select(F.count_if(F.col("copy") == 1), F.count(F.lit(1))).head()
    parts = int(max(1, min(MAX_PARTS, round(distinct**0.5 / 4), distinct // 8)))
    sample = min(FIT_PER_PART * parts, MAX_FIT, max(parts, FIT_BYTES // (8 * d)))
    of_hash = [F.xxhash64("v", F.lit(SEED)), F.col("v")]
    router = fit_router(_stored_matrix(kept.filter("copy = 1").orderBy(*of_hash).limit(sample)), parts)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = as_matrix(batch.column(1), d)
            for lo in range(0, len(x), 4096):
                v = x[lo : lo + 4096]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo : lo + 4096], batch.column(2)[lo : lo + 4096], pa.array(router.part(v), type=pa.int32()), pa.array([r.tobytes() for r in v], type=pa.binary())],
                    names=["id", "uid", "part", "v"],
                )

    index = scratch(kept.select("id", "v", "uid").mapInArrow(assign, "id long, uid long, part int, v binary"), "ann-index")
    mass = _calibrated(index, asked, router, d, k, target) if parts > 1 else 1.0

    # Units: runs of small parts, or shares of a large one.
    counts = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}
    rows_of_unit = max(1, min(UNIT_BYTES // (8 * d), -(-total // LEAST_UNITS)))
    unit_of, shares, unit, room = np.zeros(parts, dtype=np.int64), np.ones(parts, dtype=np.int64), -1, 0
    for p in range(parts):
        n = counts.get(p, 0)
        if n > room:
            unit += 1
            shares[p] = max(1, -(-n // rows_of_unit))
            room = rows_of_unit if shares[p] == 1 else 0
        unit_of[p] = unit
        room = max(0, room - n)
        unit += int(shares[p]) - 1
    place = spark.createDataFrame([(p, int(unit_of[p]), int(shares[p])) for p in range(parts)], "part int, first long, shares long")
    asked_blocks = max(1, -(-asked.count() // max(1, UNIT_BYTES // (8 * d))))
    block = F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1)))
    placed = index.join(F.broadcast(place), "part").select(
        (F.col("first") + F.pmod(F.xxhash64("uid"), "shares")).alias("unit"), block.alias("block"), "part", "id", "uid", "v"
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = as_matrix(batch.column(1), d)
            for lo in range(0, len(x), 1024):
                v = x[lo : lo + 1024]
                order_, before = router.mass_before(v)
                to: list[tuple[int, int, bytes]] = []
                for i, (ps, b) in enumerate(zip(order_, before)):
                    probed = np.sort(ps[: max(1, int(np.searchsorted(b, mass, side="left")))])
                    by_unit: dict[int, list[int]] = {}
                    for p in probed.tolist():
                        for u in range(int(unit_of[p]), int(unit_of[p] + shares[p])):
                            by_unit.setdefault(u, []).append(p)
                    to += [(i, u, np.array(ps_, dtype=np.int32).tobytes()) for u, ps_ in by_unit.items()]
                at = pa.array([lo + i for i, _, _ in to], type=pa.int64())
                packed = [r.tobytes() for r in v]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([u for _, u, _ in to], type=pa.int64()), batch.column(0).take(at), batch.column(2).take(at), pa.array([packed[i] for i, _, _ in to], type=pa.binary()), pa.array([b for _, _, b in to], type=pa.binary())],
                    names=["unit", "id", "uid", "v", "parts"],
                )

    routed = asked.select("id", "v", "uid").mapInArrow(route, "unit long, id long, uid long, v binary, parts binary")
    routed = routed.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(asked_blocks)).cast("int"))

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        part = left["part"].to_numpy()
        by_part = np.argsort(part, kind="stable")
        ids, uids, x = left["id"].to_numpy()[by_part], left["uid"].to_numpy()[by_part], from_bytes(left["v"], d)[by_part]
        q = Best(from_bytes(right["v"], d), right["uid"].to_numpy(), k)
        probed = [np.frombuffer(b.as_py(), dtype=np.int32) for b in right["parts"]]
        who = np.repeat(np.arange(len(probed)), [len(b) for b in probed])
        where = np.concatenate(probed) if probed else np.zeros(0, dtype=np.int32)
        ordered = part[by_part]
        for p in np.unique(where).tolist():
            lo, hi = np.searchsorted(ordered, [p, p + 1])
            q.add(who[where == p], ids[lo:hi], uids[lo:hi], np.zeros(hi - lo, dtype=np.int64), x[lo:hi])
        at, score, id_, uid, _ = q.found
        return pa.table(
            {"query_row": right["uid"].to_numpy()[at], "query_id": right["id"].to_numpy()[at], "vec_id": id_, "vec_row": uid, "score": score},
            schema=pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("vec_row", pa.int64()), ("score", pa.float64())]),
        )

    found = placed.groupBy("unit", "block").cogroup(routed.groupBy("unit", "block")).applyInArrow(look, "query_row long, query_id long, vec_id long, vec_row long, score double")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "vec_row"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "query_row", "vec_row")


def _calibrated(index: DataFrame, asked: DataFrame, router: Router, d: int, k: int, target: float) -> float:
    """The mass of probability to probe so that a sample of the queries finds ``target`` of its true neighbours.

    The sample's neighbours among all rows come from a scan of the index;
    the driver sees ``k`` of them for each of at most ``CALIBRATION`` queries.
    """
    sample = asked.orderBy(F.xxhash64("v", F.lit(SEED + 1)), "uid").limit(CALIBRATION).select("v", "uid").toArrow()
    queries, uids = np.array(sample["v"].to_pylist(), dtype=np.float64), sample["uid"].to_numpy()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(queries, uids, k)
        everyone = np.arange(len(queries))
        for batch in batches:
            t = pa.Table.from_batches([batch])
            x = from_bytes(t["v"], d)
            best.add(everyone, t["id"].to_numpy(), t["uid"].to_numpy(), t["part"].to_numpy().astype(np.int64), x)
        query, score, id_, uid, part = best.found
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (query, score, id_, uid, part)], names=["query", "score", "id", "uid", "part"])

    found = index.mapInArrow(scan, "query long, score double, id long, uid long, part long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "id", "uid"))
    true = found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query", "part").toPandas()
    if not len(true):
        return 1.0
    order, before = router.mass_before(queries)
    mass = np.empty_like(before)
    np.put_along_axis(mass, order, before, axis=1)
    needed = np.sort(mass[true["query"].to_numpy(), true["part"].to_numpy()])
    # a little more: a batch of another shape moves the last digits of the probabilities
    return float(needed[min(len(needed), max(1, int(np.ceil(target * len(needed))))) - 1]) + 1e-9
