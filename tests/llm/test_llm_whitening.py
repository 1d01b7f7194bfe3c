import math
from fractions import Fraction

import numpy as np
import pytest

from panelspark.llm import whitening
from panelspark.llm.whitening import bit_planes, scatter, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, x string, id string, n long, component int, raw string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 0, "x", "y", 1, 2, "z") for i, e in rows], SCHEMA).repartition(3)


def sound(rows):
    ok = [(i, e) for i, e in rows if e and all(c is not None and math.isfinite(c) for c in e)]
    return [(i, tuple(math.floor(256 * float(np.float32(c))) for c in e)) for i, e in ok]


def check(got, rows, k=4):
    xs = sound(rows)
    fit = sorted({x for _, x in xs})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    cov = [[float(Fraction(n * sum(x[a] * x[b] for x in fit) - sums[a] * sums[b], n * n)) for b in range(d)] for a in range(d)]
    values = np.sort(np.linalg.eigvalsh(np.array(cov)))[::-1]
    m = int((values[:k] > 1e-9).sum())
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, int(r["deviation"]), r["component"]) for r in got) == sorted(
        (i is None, i or 0, sum((n * a - s) ** 2 for a, s in zip(x, sums)), c) for i, x in xs for c in range(1, m + 1)
    )
    assert {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] <= 1e-4
    for r in got:
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / sum(cov[a][a] for a in range(d)), rel=1e-9)
    # recover the component from the whitened values of the fit list: it must be a unit eigenvector of the covariance
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], int(r["deviation"])), {})[r["component"]] = r["whitened"]
    centred = np.array([[a - s / n for a, s in zip(x, sums)] for x in fit])
    z = np.array([[by[next(i for i, y in xs if y == x), sum((n * a - s) ** 2 for a, s in zip(x, sums))][c] for c in range(1, m + 1)] for x in fit])
    assert np.abs(z.T @ z / n - np.eye(m)).max() < 1e-6
    for c in range(m):
        w = centred.T @ z[:, c] / n / math.sqrt(values[c])  # V u / e = u
        assert np.linalg.norm(w) == pytest.approx(1, abs=1e-6)
        assert np.abs(np.array(cov) @ w - values[c] * w).max() < 1e-6 * values[0]


def test_planes_and_scatter_are_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(-70, 300, size=(517, 5))
    x[:, 3] = 4
    planes, dims, bits = bit_planes(x - x.min(axis=0))
    assert 3 not in dims and planes.shape[1] == 9
    back = np.zeros((517, 5), dtype=np.int64)
    for p, i, b in zip(planes, dims, bits):
        back[:, i] += np.unpackbits(p.view(np.uint8))[:517].astype(np.int64) << b
    assert (back == x - x.min(axis=0)).all()
    for scale in (1, 10**12):  # 64-bit sums do, and do not hold the products
        y = x * scale
        sums, products = scatter(y)
        o = y.astype(object)
        assert sums.tolist() == o.sum(axis=0).tolist()
        assert all(products[i, j] == (o[:, i] * o[:, j]).sum() for i in range(5) for j in range(i, 5))


@pytest.mark.parametrize("block", [1 << 16, 50])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block)
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=6) * [1, 0.5, 0.3, 0.2, 0.1, 0.05]]) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(150)]  # a third of the rows is one vector
    rows += [(5, rows[5][1]), (None, rows[7][1]), (None, None), (700, None), (701, []), (702, [None] * 6)]
    rows += [(703, [math.inf] * 6), (704, [math.nan] * 6), (705, [-0.0, 0.0, -0.001, 1.0, 2.0, 3.0])]
    check(whiten(frame(spark, rows)).collect(), rows)


def test_few_directions_and_empty(spark):
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(10)]
    got = whiten(frame(spark, line)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 10
    check(got, line)
    assert whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one distinct vector: no variance
    assert whiten(frame(spark, [])).count() == 0
    assert whiten(frame(spark, [(1, None), (2, [])])).count() == 0


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=3) * 1e10]) for i in range(40)]
    xs = sound(rows)
    sums = [sum(x[j] for _, x in xs) for j in range(3)]
    got = {r["vec_id"]: int(r["deviation"]) for r in whiten(frame(spark, rows)).collect()}
    assert got == {i: sum((40 * a - s) ** 2 for a, s in zip(x, sums)) for i, x in xs}


def test_other_dimensions_raise(spark):
    with pytest.raises(Exception, match="dimensions"):
        whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0]), (3, [3.0, 4.0])])).collect()
