import pytest
from pyspark.sql import functions as F

from panelspark.functions import scalars as S
from panelspark.operators import quality as Q


def counts(df, keys, **kw):
    return tuple(Q.unique_violations(df, keys, **kw).first())


ROWS = [(1, "a"), (1, "a"), (1, None), (None, "a"), (None, None), (None, None), (2, "b"), (1, "b")]


@pytest.mark.parametrize("hashed", [F.xxhash64, lambda *c: F.lit(7).cast("long"), lambda *c: F.pmod(F.xxhash64(*c), F.lit(2))])
def test_collisions_are_told_from_copies(spark, hashed):
    df = spark.createDataFrame(ROWS, "k int, v string")
    assert counts(df, ["k", "v"], hashed=hashed) == (2, 6, 8)
    assert counts(df, ["v"], hashed=hashed) == (5, 3, 8)
    distinct = df.distinct()
    assert counts(distinct, ["k", "v"], hashed=hashed) == (0, 6, 6)
    assert counts(df.limit(0), ["k", "v"], hashed=hashed) == (0, 0, 0)


def test_the_shuffle_carries_hashes(spark):
    df = spark.range(1000).selectExpr("id AS wide_key", "concat('some long text ', id) AS text_key")
    plan = Q.unique_violations(df, ["wide_key", "text_key"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(__h" in line]
    assert any("HashAggregate(keys=[__h" in x and "partial_count" in x for x in below)
    assert "LeftSemi" in plan  # full keys only of hashes that repeat
    assert counts(df, ["wide_key", "text_key"]) == (0, 1000, 1000)


def test_gate_counts_duplicates(spark):
    df = spark.createDataFrame(ROWS, "k int, v string")
    rows = {r.rule: r.violations for r in Q.dq_report(df, Q.Spec(unique=["k", "v"])).collect()}
    assert rows["unique"] == 2


def test_samples_of_all_rules_come_from_one_scan(spark, tmp_path):
    spark.range(2000).selectExpr("CAST(id % 100 AS INT) AS n", "IF(id % 7 = 0, NULL, concat('s', id % 12)) AS s", "id / 4 AS x").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    checks = [Q.range_check("n", None, 90), Q.RowCheck("in_set", "s", S.fn_in_set("s", ["s0", "s1", "s2"])), Q.range_check("x", 100, None),
              Q.RowCheck("never", "n", F.col("n") >= 0), Q.range_check("n", 3, None), Q.RowCheck("given", "s", F.col("s").isNotNull())]
    out = Q.violations_sample(df, checks)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r["check"], r["rank"])):
        got.setdefault((r["check"], r["rule"], r["column"]), []).append(r["value"])
    assert got[0, "in_range", "n"] == ["91"] * 5 and got[4, "in_range", "n"] == ["0"] * 5
    assert got[1, "in_set", "s"] == ["s10"] * 5 and got[2, "in_range", "x"] == ["0.0", "0.25", "0.5", "0.75", "1.0"]
    assert got[5, "given", "s"] == [None] * 5 and not any(k[0] == 3 for k in got)
    with pytest.raises(Q.QualityError, match="91") as e:
        Q.validate(df, Q.Spec(checks=checks))
    assert set(e.value.samples) == {("in_range", "n"), ("in_set", "s"), ("in_range", "x"), ("given", "s")}
