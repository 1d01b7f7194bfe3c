"""The one-shuffle outer merge equals a chain of full outer joins."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.operators.quality import QualityError
from panelspark.operators.reshape import merge_variants, merge_variants_union
from panelspark.plans.panels import build_panel
from panelspark import specs


def brute(tables):
    """Each key's rows of all tables in all combinations; None where a table lacks the key."""
    keys = {r[:2] for t in tables for r in t}
    out = []
    for key in keys:
        combos = [()]
        for i, t in enumerate(tables):
            width = 2 if i == 0 else 1
            mine = [r[2:] for r in t if r[:2] == key] or [(None,) * width]
            combos = [c + m for c in combos for m in mine]
        out += [key + c for c in combos]
    return sorted(map(str, out))


def frames(spark, tables):
    first = spark.createDataFrame(tables[0], "RegionID long, date string, name string, v0 double")
    rest = [spark.createDataFrame(t, f"RegionID long, date string, v{i} double").withColumn("name", F.lit("other")) for i, t in enumerate(tables[1:], 1)]
    return [(df, f"v{i}") for i, df in enumerate([first, *rest])]


def got(df):
    return sorted(str(tuple(r)) for r in df.collect())


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


key = st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "2024-01-31", "2024-02-29"]))
value = st.sampled_from([None, 1.0, 2.5])
first = st.lists(st.tuples(key, st.sampled_from(["a", None]), value).map(lambda x: (*x[0], *x[1:])), max_size=6)
later = st.lists(st.tuples(key, value).map(lambda x: (*x[0], x[1])), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.tuples(first, later, later), st.sampled_from([1, 2, 10_000]))
def test_equals_all_combinations(spark, tables, hot_rows):
    assert got(merge_variants(frames(spark, list(tables)), hot_rows=hot_rows)) == brute(list(tables))


def test_without_null_safety_null_keys_pass_by(spark):
    tables = [[(1, "d", "a", 1.0), (None, "d", "n", 2.0)], [(1, "d", 5.0), (None, "d", 6.0)], [(None, None, 7.0)]]
    longs = frames(spark, tables)
    want = longs[0][0].join(longs[1][0].select("RegionID", "date", "v1"), ["RegionID", "date"], "full").join(
        longs[2][0].select("RegionID", "date", "v2"), ["RegionID", "date"], "full")
    assert got(merge_variants(longs, null_safe=False)) == got(want)


def test_a_hot_null_region_is_spread_and_loses_nothing(spark):
    hot = [(None, "d", None, float(i)) for i in range(900)]
    tables = [hot + [(1, "d", "a", 1.0)], [(None, "d", 7.0), (None, "d", 8.0), (2, "d", 1.0)], [(None, "d", float(i)) for i in range(5)]]
    merged = merge_variants(frames(spark, tables), hot_rows=50)
    assert merged.count() == 900 * 2 * 5 + 2
    assert got(merged) == brute(tables)


def test_one_exchange_whatever_the_number_of_variants(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for n in (2, 3, 7):
            tables = [[(1, "d", "a", 1.0)]] + [[(1, "d", float(i))] for i in range(1, n)]
            assert exchanges(merge_variants(frames(spark, tables))) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_union_grid_is_null_safe_and_refuses_repeats(spark):
    cols = "RegionID long, RegionName string, RegionType string, StateName string, `2024-01-31` string"
    a = spark.createDataFrame([(1, "A", "zip", "CA", "5"), (None, "N", "zip", None, "6"), (3, "C", "msa", None, "9")], cols)
    b = spark.createDataFrame([(1, None, "zip", "NY", "7"), (None, "n", "zip", "TX", "8"), (4, "D", "zip", None, "1")], cols)
    rows = {r.RegionID: r for r in merge_variants_union([(a, "x"), (b, "y")], "zip").collect()}
    assert set(rows) == {1, None, 4}
    assert (rows[1].RegionName, rows[1].StateName, rows[1].x, rows[1].y) == ("A", "CA", "5", "7")
    assert (rows[None].RegionName, rows[None].StateName, rows[None].x, rows[None].y) == ("N", "TX", "6", "8")
    twice = b.unionAll(b.where("RegionID = 1"))
    frames_ = [(a, "for_sale_inventory"), (twice, "new_listings")]
    with pytest.raises(QualityError):
        build_panel(frames_, specs.INVENTORY, "zip", grid="union")
    assert build_panel([(a, "for_sale_inventory"), (b, "new_listings")], specs.INVENTORY, "zip", grid="union").count() == 3


def test_partitions_follow_the_rows(spark, monkeypatch):
    from panelspark.operators import reshape as R

    monkeypatch.setattr(R, "MERGE_ROWS", 100)
    a = spark.range(300).selectExpr("id AS RegionID", "'2020-01-31' AS date", "id * 2 AS x")
    b = spark.range(200, 500).selectExpr("id AS RegionID", "'2020-01-31' AS date", "id * 3 AS y")
    got = R.merge_variants([(a, "x"), (b, "y")])
    assert got.rdd.getNumPartitions() == 7
    want = [(i, "2020-01-31", 2 * i if i < 300 else None, 3 * i if i >= 200 else None) for i in range(500)]
    assert sorted(map(tuple, got.select("RegionID", "date", "x", "y").collect())) == want
