import math

import numpy as np
import pytest

from panelspark.llm import topk
from panelspark.llm.topk import search

SCHEMA = "vec_id long, embedding array<float>, label int, v string, uid long, id string"


def brute(rows, k):
    ok = [(i, [math.floor(256 * float(x)) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, (i, a) in enumerate(ok):
        if i % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), j) for p, (j, b) in enumerate(ok) if p != q and len(b) == len(a))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("at_once, rows_at_once", [(8192, 65536), (3, 65536), (8192, 100), (5, 150)])
def test_equals_brute_force(spark, monkeypatch, at_once, rows_at_once):
    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", at_once)
    monkeypatch.setattr(topk, "ROWS_AT_ONCE", rows_at_once)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(0)
    f = lambda a: [float(np.float32(x)) for x in a]
    rows = [(i, f(rng.normal(size=8) * (0.01 if i % 3 else 1))) for i in range(600)]  # many ties at small scale
    rows += [(600 + i, f([0.5] * 8)) for i in range(60)] + [(50, rows[50][1]), (700, None), (None, f([1] * 8))]
    rows += [(750, [None] + f([1] * 7)), (800, f([math.inf] + [1] * 7)), (850, f([math.nan] * 8)), (900, f([1, 2])), (901, f([3, 4])), (950, [])]
    df = spark.createDataFrame([(i, e, 0, "x", 1, "y") for i, e in rows], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in search(df, "id % 50 = 0").select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute(rows, 5)


def test_empty_table(spark):
    assert search(spark.createDataFrame([], SCHEMA), "id % 50 = 0").count() == 0
    one = spark.createDataFrame([(50, [1.0], 0, "x", 1, "y")], SCHEMA)
    assert search(one, "id % 50 = 0").count() == 0


def test_no_vector_passes_through_the_driver(spark, monkeypatch):
    rows = [(i, [float(i % 7), 1.0], 0, "x", 1, "y") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    frame, collect = type(df), type(df).collect

    def only_numbers(self):
        assert not any(c in self.columns for c in ("v", "embedding"))
        return collect(self)

    monkeypatch.setattr(frame, "collect", only_numbers)
    for name in ("toArrow", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(frame, name, lambda *a, **k: pytest.fail("rows were sent to the driver"))
    search(df, "id % 50 = 0").write.format("noop").mode("overwrite").save()


def test_equal_rows_spread_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS_AT_ONCE", 50)
    df = spark.createDataFrame([(50, [1.0], 0, "x", 1, "y")] * 200, SCHEMA)
    got = search(df, "id % 50 = 0").groupBy("query_row").count().collect()
    assert len(got) == 200 and {r["count"] for r in got} == {5}
