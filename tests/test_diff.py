from pyspark.sql import functions as F

from panelspark.operators import diff as D


def test_table_changed(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k bigint, v string")
    assert D.table_changed(a, None)
    assert not D.table_changed(a, a.orderBy(F.desc("k")))  # order-free
    assert D.table_changed(a, a.withColumn("v", F.lit("z")))
    assert D.table_changed(a, a.select("k"))
    assert D.table_changed(a, a.limit(1))


def test_table_diff_counts_duplicates(spark):
    new = spark.createDataFrame([(1,), (1,), (2,)], "k bigint")
    old = spark.createDataFrame([(1,), (3,)], "k bigint")
    assert sorted((r.k, r.change) for r in D.table_diff(new, old).collect()) == [(1, "+"), (2, "+"), (3, "-")]


def test_state_diff(spark):
    old = spark.createDataFrame([("a", "1"), ("b", None), ("_metadata", "t1"), ("c", "3")], "key string, value string")
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("_metadata", "t2"), ("d", "4")], "key string, value string")
    got = sorted(tuple(r) for r in D.state_diff(old, new).collect())
    assert got == [("b", "", "2"), ("c", "3", ""), ("d", "", "4")]


def test_table_diff_splits_hot_duplicate_groups(spark):
    new = spark.createDataFrame([(7,)] * 11 + [(1,)], "k bigint")
    old = spark.createDataFrame([(7,), (2,)], "k bigint")
    got = D.table_diff(new, old, chunk=3)
    assert sorted((r.k, r.change) for r in got.collect()) == [(1, "+")] + [(2, "-")] + [(7, "+")] * 10
