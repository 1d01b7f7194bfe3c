import math
from collections import Counter

import numpy as np
import pytest

from panelspark.llm import ann
from panelspark.llm.ann import balanced_parts, fit_router, neighbour_graph, search

SCHEMA = "vec_id long, embedding array<float>, label int, v string, uid long, id string, part int, unit int"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 0, "x", 1, "y", 2, 3) for i, e in rows], SCHEMA).repartition(3)


def brute(rows, k, every=20):
    """(query id, [(vec id, score)]) of each query row, by plain sums in double precision."""
    ok = [(i, [float(np.float32(x)) for x in e]) for i, e in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    out = []
    for q, (i, a) in enumerate(ok):
        if i % every == 0:
            scored = []
            for p, (j, b) in enumerate(ok):
                if p != q:
                    s = 0.0
                    for x, y in zip(a, b):
                        s += x * y
                    scored.append((-s, j))
            out.append((i, [(j, -s) for s, j in sorted(scored)[:k]]))
    return sorted(out)


def grouped(found):
    by = {}
    for r in found:
        by.setdefault((r["query_id"], r["query_row"]), []).append((r["rank"], r["vec_id"], r["score"]))
    for v in by.values():
        v.sort()
        assert [x[0] for x in v] == list(range(1, len(v) + 1))
    return sorted((q, [(j, s) for _, j, s in v]) for (q, _), v in by.items())


@pytest.fixture(scope="module")
def points():
    """Clusters, noise, and a third of all rows equal."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    x = np.concatenate([centres[rng.integers(0, 40, 1200)] + 0.2 * rng.normal(size=(1200, 16)), rng.normal(size=(600, 16))])
    x = np.concatenate([x, np.repeat(x[:1], 900, axis=0)])[rng.permutation(2700)]
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


def test_recall_and_exact_scores(spark, points):
    got, want = grouped(search(frame(spark, points), "id % 20 = 0").collect()), brute(points, 20)
    assert [q for q, _ in got] == [q for q, _ in want] and all(len(v) == 20 for _, v in got)
    vectors = {i: np.array(e) for i, e in points}
    for q, v in got:
        assert v == sorted(v, key=lambda x: (-x[1], x[0])) and q not in [j for j, _ in v]
        for j, s in v:
            assert s == pytest.approx(float(vectors[q] @ vectors[j]), rel=1e-12, abs=1e-12)
    hit = [len({j for j, _ in a} & {j for j, _ in b}) / 20 for (_, a), (_, b) in zip(got, want)]
    assert np.mean(hit) >= 0.9
    copies = Counter(tuple(e) for _, e in points)
    equal = [i for i, e in points if copies[tuple(e)] > 100 and i % 20 == 0]
    assert len(equal) > 30 and all(dict(got)[q] == dict(want)[q] for q in equal)  # ties of the copies go to the smallest ids


def test_all_parts_probed_equals_brute_force(spark, points, monkeypatch):
    monkeypatch.setattr(ann, "UNIT_BYTES", 16 * 8 * 100)  # many units, large parts spread, several blocks of queries
    rows = points[:700] + [(40, points[40][1]), (40, points[40][1]), (7000, [0.0] * 16), (7020, None), (7040, [None] * 16), (7060, [math.nan] * 16), (None, points[3][1]), (7080, [])]
    got = grouped(search(frame(spark, rows), "id % 20 = 0", target=1.0).collect())
    want = brute(rows, 20)
    assert [q for q, _ in got] == [q for q, _ in want]
    # the sample covers all queries here, so a target of 1 finds every neighbour
    for (_, a), (_, b) in zip(got, want):
        assert [j for j, _ in a] == [j for j, _ in b]
        assert [s for _, s in a] == [s for _, s in b]


def test_small_tables(spark):
    assert search(frame(spark, []), "id % 20 = 0").count() == 0
    assert search(frame(spark, [(20, [1.0, 2.0])]), "id % 20 = 0").count() == 0
    assert search(frame(spark, [(21, [1.0, 2.0]), (20, None)]), "id % 20 = 0").count() == 0
    few = [(20, [1.0, 0.0]), (1, [0.5, 1.0]), (2, [-1.0, 0.0]), (3, [0.5, -1.0])]
    assert grouped(search(frame(spark, few), "id % 20 = 0").collect()) == [(20, [(1, 0.5), (3, 0.5), (2, -1.0)])]


def test_other_dimensions_raise(spark):
    with pytest.raises(Exception, match="dimensions"):
        search(frame(spark, [(20, [1.0, 2.0]), (1, [1.0])]), "id % 20 = 0").collect()


def test_parts_are_balanced_and_cut_fewer_edges():
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(16, 8)), 64, axis=0) + 0.3 * rng.normal(size=(1024, 8))
    graph = neighbour_graph(x, 10)
    part = balanced_parts(x, graph, 16)
    sizes = np.bincount(part, minlength=16)
    assert sizes.max() <= math.ceil(1.1 * 64) and sizes.min() >= int(0.9 * 64)
    cut = (part[:, None] != part[graph]).mean()
    assert cut < 0.6 * (rng.permutation(part)[:, None] != part[graph]).mean()
    router = fit_router(x, 16)
    order, before = router.mass_before(x)
    assert (np.diff(before, axis=1) >= 0).all() and sorted(order[0].tolist()) == list(range(16))
