"""Embedding whitening from an exact covariance, computed on bit planes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, scratch

#: Rows whose bit planes are held at once (of 64 dimensions and 9 planes: 5 MB).
BLOCK_ROWS = 1 << 16
#: Eigenvalues below this share of the largest are rounding, not variance.
FLAT = 1e-12
_SAFE = 2**62
#: What an exact sum must stay below to fit decimal(38, 0).
_DECIMAL = 10**38


def quantised_vectors(vectors: DataFrame, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x array<bigint>), x = floor(scale * c): the rows whose vector is not null or empty and has only finite entries."""
    rows = pick(vectors, id=id_col, raw=vector_col).withColumn("raw", F.col("raw").cast("array<double>"))
    sound = F.forall("raw", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = rows.filter(F.col("raw").isNotNull() & (F.size("raw") > 0)).filter(sound)
    return kept.select("id", F.transform("raw", lambda c: F.floor(c * F.lit(float(scale))).cast("bigint")).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """The vectors of a batch as rows; vectors of another dimension raise."""
    offsets = column.offsets.to_numpy()
    if len(offsets) and (np.diff(offsets) != d).any():
        raise ValueError(f"vectors must all have {d} dimensions")
    values = column.values.to_numpy(zero_copy_only=False)
    return values[offsets[0] : offsets[-1]].reshape(-1, d)


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(planes, dimension, bit): the bits of non-negative integers, the rows of a plane packed into 64-bit words.

    ``planes[p]`` has one bit for each row of ``shifted``: bit ``bit[p]`` of
    dimension ``dimension[p]``. A dimension has as many planes as its
    largest value needs; a constant dimension has none.
    """
    n, d = shifted.shape
    words = -(-n // 64)
    rows, dims, bits = [], [], []
    for i in range(d):
        column = np.ascontiguousarray(shifted[:, i])
        for b in range(int(column.max()).bit_length() if n else 0):
            packed = np.packbits((column >> b & 1).astype(bool))
            rows.append(np.pad(packed, (0, words * 8 - len(packed))).view(np.uint64))
            dims.append(i)
            bits.append(b)
    planes = np.array(rows, dtype=np.uint64).reshape(len(rows), words)
    return planes, np.array(dims, dtype=np.int64), np.array(bits, dtype=np.int64)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, products) of integer rows, exact, as Python integers: sum x_i and sum x_i * x_j for j >= i.

    Each dimension is shifted to start at 0 and cut into bit planes; the
    popcount of two planes' AND, times the planes' weights, adds up to the
    cross-products of the shifted values. The shift is then undone.
    """
    n, d = x.shape
    low = [int(v) for v in x.min(axis=0)]
    if max(int(v) for v in x.max(axis=0)) - min(low) >= 2**63:
        raise ValueError("quantised entries must lie less than 2^63 apart")
    planes, dims, bits = bit_planes(x - x.min(axis=0))
    exact = int(np.max(bits, initial=0)) * 2 + 2 + n.bit_length() < 62  # then int64 holds every weighted sum
    kind = np.int64 if exact else object
    shifted = np.zeros((d, d), dtype=kind)
    sums = np.zeros(d, dtype=kind)
    starts = np.searchsorted(dims, np.arange(d + 1))
    weight = np.array([1 << int(b) for b in bits], dtype=kind)
    for p in range(len(planes)):
        i = dims[p]
        shared = np.bitwise_count(planes[p] & planes[starts[i] :]).sum(axis=1, dtype=np.int64).astype(kind)
        sums[i] += weight[p] * shared[p - starts[i]]
        np.add.at(shifted, (i, dims[starts[i] :]), weight[p] * weight[starts[i] :] * shared)
    s = [int(v) for v in sums]
    products = np.empty((d, d), dtype=object)
    for i in range(d):
        for j in range(i, d):
            products[i, j] = int(shifted[i, j]) + low[i] * s[j] + low[j] * s[i] + n * low[i] * low[j]
    return np.array([s[i] + n * low[i] for i in range(d)], dtype=object), products


def fit_list(quantised: DataFrame) -> DataFrame:
    """Each distinct x vector once, stored: copies are merged before the shuffle, so a hot vector is one row a task."""
    return scratch(quantised.select("x").distinct(), "whiten-fit")


def exact_scatter(fit: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, products) of the fit list as Python integers; ``products`` is symmetric.

    Tasks send their exact sums, d * (d + 1) / 2 numbers, which Spark adds
    up as decimals; the driver sees as many numbers, whatever the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)
        upper = np.triu_indices(d)
        held: list[np.ndarray] = []

        def add() -> None:
            nonlocal sums, products
            x = np.concatenate(held)
            held.clear()
            s, p = scatter(x)
            sums = sums + s
            products[upper] = products[upper] + p[upper]

        for batch in batches:
            x = _matrix(batch.column(0), d)
            for lo in range(0, len(x), BLOCK_ROWS):
                held.append(x[lo : lo + BLOCK_ROWS])
                n += len(held[-1])
                if sum(map(len, held)) >= BLOCK_ROWS:
                    add()
        if held:
            add()
        if not n:
            return
        i = np.concatenate([[-1], np.full(d, -1), upper[0]])
        j = np.concatenate([[-1], np.arange(d), upper[1]])
        values = [n, *sums, *products[upper]]
        if max(abs(int(v)) for v in values) >= _DECIMAL:
            raise ValueError("the cross-products of the quantised vectors do not fit 38 digits")
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, type=pa.int32()), pa.array(j, type=pa.int32()), pa.array([Decimal(int(v)) for v in values], type=pa.decimal128(38, 0))],
            names=["i", "j", "v"],
        )

    found = fit.mapInArrow(run, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    n, sums, products = 0, [0] * d, np.zeros((d, d), dtype=object)
    for i, j, v in found:
        if j < 0:
            n = int(v)
        elif i < 0:
            sums[j] = int(v)
        else:
            products[i, j] = products[j, i] = int(v)
    return n, sums, products


def components(n: int, sums: list[int], products: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns, share of the trace) of the covariance, the largest first, at most ``most``.

    The scatter is centred as integers, n * sum x_i x_j - S_i * S_j, so no
    digits cancel; it is divided by n^2 last. A direction without variance
    is left out, as it can't be scaled to variance 1.
    """
    d = len(sums)
    v = np.array([[(n * int(products[i, j]) - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)], dtype=float).reshape(d, d)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > FLAT * max(float(values.max(initial=0.0)), 0.0)]
    trace = math.fsum(np.diag(v))
    return values[order], vectors[:, order], values[order] / trace if trace > 0 else values[order]


def whiten(vectors: DataFrame, k: int = 4, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each vector that takes part and each of the first ``k`` components:
    (vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error).

    Entries are quantised to x = floor(scale * c). Rows whose vector is
    null, empty, or holds a null or non-finite entry take no part; a row
    with a null id does. Repeated rows each get their rows, but the fit list
    has every distinct x once. ``deviation`` is the sum over dimensions of
    (n * x - S)^2, ``whitened`` the centred x projected on the component,
    over the root of its eigenvalue. Components without variance are left
    out: fewer than ``k`` distinct directions give fewer rows, a single
    distinct vector or an empty table none. Vectors of different dimensions
    raise, as do entries too large for exact sums of 38 digits. Columns
    other than the two named are ignored.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    quantised = quantised_vectors(vectors, scale, id_col, vector_col)
    fit = fit_list(quantised)
    first = fit.select(F.size("x")).head()
    if first is None:
        return spark.createDataFrame([], schema)
    d = first[0]
    n, sums, products = exact_scatter(fit, d)
    values, directions, explained = components(n, sums, products, k)
    m = len(values)
    if not m:
        return spark.createDataFrame([], schema)
    totals = np.array(sums, dtype=object)
    # |n * x - S| is at most n * range, and the root of n^2 * the scatter's diagonal bounds it as well
    widest = max(math.isqrt(max(n * int(products[i, i]) - sums[i] ** 2, 0) * n) + 1 for i in range(d))
    narrow = widest * widest * d < _SAFE and max(abs(s) for s in sums) < _SAFE and n * max(math.isqrt(int(products[i, i])) + 1 for i in range(d)) < _SAFE
    projection = directions / np.sqrt(values) / n

    def whitened(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - S, exact; its projections)."""
        centred = x * np.int64(n) - totals.astype(np.int64) if narrow else x.astype(object) * n - totals
        return centred, centred.astype(float) @ projection

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a task: rows, means and centred products of what it whitened."""
        count, mean, around = 0, np.zeros(m), np.zeros((m, m))
        for batch in batches:
            if not batch.num_rows:
                continue
            z = whitened(_matrix(batch.column(0), d))[1]
            own = z.mean(axis=0)
            step = own - mean
            both = count + len(z)
            around += (z - own).T @ (z - own) + np.outer(step, step) * (count * len(z) / both)
            mean, count = mean + step * (len(z) / both), both
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array([count], type=pa.int64()), pa.array([mean.tolist()], type=pa.list_(pa.float64())), pa.array([around.ravel().tolist()], type=pa.list_(pa.float64()))],
                names=["rows", "mean", "around"],
            )

    parts = scratch(fit.mapInArrow(moments, "rows long, mean array<double>, around array<double>"), "whiten-moments")
    means = parts.select(*[(F.sum(F.col("rows") * F.col("mean")[a]) / n).alias(f"m{a}") for a in range(m)]).head()
    apart = lambda a: F.col("mean")[a] - F.lit(float(means[a]))
    covariance = parts.select(
        *[(F.sum(F.col("around")[a * m + b] + F.col("rows") * apart(a) * apart(b)) / n).alias(f"c{a}_{b}") for a in range(m) for b in range(m)]
    ).head()
    error = float(np.abs(np.array(covariance, dtype=float).reshape(m, m) - np.eye(m)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            centred, z = whitened(_matrix(batch.column(1), d))
            deviation = pa.array([Decimal(int(v)) for v in (centred * centred).sum(axis=1)], type=pa.decimal128(38, 0))
            owner = pa.array(np.repeat(np.arange(batch.num_rows), m))
            times = len(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()).take(owner),
                    pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(times, n, dtype=np.int64)),
                    deviation.take(owner),
                    pa.array(z.ravel()),
                    pa.array(np.tile(explained, batch.num_rows)),
                    pa.array(np.full(times, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return quantised.mapInArrow(project, schema)
