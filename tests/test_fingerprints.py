import pytest
from pyspark.sql import functions as F

from panelspark.operators import diff as D
from panelspark.operators.fingerprints import differing, fingerprints
from panelspark.sinks.table import Table

SCHEMA = "date string, k bigint, v double, w string"


def table(spark, path, rows, schema=SCHEMA, fn="substring({}, 1, 4)"):
    t = Table(spark, str(path), partition_col="date", partition_fn=fn, fingerprints=True)
    t.write(spark.createDataFrame(rows, schema).repartition(3))
    return t


def diff(a, b):
    return sorted(str(tuple(r)) for r in D.stored_diff(a, b).collect())


@pytest.fixture(scope="module")
def rows():
    out = [(f"{2015 + i % 6}-01-31", i, None if i % 7 == 0 else i / 2, f"r{i % 5}") for i in range(600)]
    return out + [(None, i, 1.0, None) for i in range(5)] + [("2015-01-31", 1000, 2.0, "copy")] * 300


def test_order_copies_and_null_positions_count(spark, rows):
    leaves = lambda data: fingerprints(spark.createDataFrame(data, SCHEMA).withColumn("p", F.lit("x")), "p")
    same = leaves(rows[::-1])
    assert differing(leaves(rows), same, "p").isEmpty()
    assert not differing(leaves(rows), leaves(rows[:-1]), "p").isEmpty()
    two = [spark.createDataFrame([x], "a long, b long").withColumn("p", F.lit("x")) for x in ((1, None), (None, 1))]
    assert not differing(*[fingerprints(df, "p") for df in two], "p").isEmpty()  # hashes alone pass over nulls


def test_diff_equals_the_diff_of_frames(spark, tmp_path, rows):
    changed = [(d, k, 9.0 if k == 17 else v, w) for d, k, v, w in rows if k != 40] + [("2031-01-31", 1, 1.0, "new"), (None, 99, None, None)]
    a, b = table(spark, tmp_path / "a", changed), table(spark, tmp_path / "b", rows)
    want = sorted(str(tuple(r)) for r in D.table_diff(a.read(), b.read()).collect())
    assert diff(a, b) == want and len(want) == 5
    assert D.stored_changed(a, b) and not D.stored_changed(b, table(spark, tmp_path / "c", rows[::-1]))
    assert diff(b, Table(spark, str(tmp_path / "c"))) == []


def test_only_differing_partitions_are_scanned_and_rows_shuffled(spark, tmp_path, rows):
    changed = [(d, k, 9.0 if k == 17 else v, w) for d, k, v, w in rows]  # row 17 is of 2020
    a, b = table(spark, tmp_path / "a", changed), table(spark, tmp_path / "b", rows)
    out = D.stored_diff(a, b)
    assert [(r.k, r.change) for r in out.orderBy("change").collect()] == [(17, "+"), (17, "-")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) >= 2 and all("PartitionFilters: [(isnotnull(__part" in s or "= 2020)" in s for s in scans)
    leaves = differing(a.read_fingerprints(), b.read_fingerprints(), "__part").collect()
    assert {r["__part"] for r in leaves} == {"2020"} and len(leaves) <= 2  # the buckets of the old row and the new


def test_merges_and_appends_keep_the_tree_true(spark, tmp_path, rows):
    t = table(spark, tmp_path / "t", rows[:300])
    t.write(spark.createDataFrame(rows[300:], SCHEMA), "append")
    assert not D.stored_changed(t, table(spark, tmp_path / "whole", rows))
    t.write(spark.createDataFrame([("2016-01-31", 1, 5.0, "x", 7)], SCHEMA + ", extra int"), "merge", key=["date", "k"])
    again = table(spark, tmp_path / "again", [tuple(r) for r in t.read().collect()], SCHEMA + ", extra int")
    assert not D.stored_changed(t, again) and diff(t, again) == []
    t.write(spark.createDataFrame([("2016-01-31", 7, 5.0, "x", 8)], SCHEMA + ", extra int"), "merge", key="k")  # all of it is rewritten
    assert diff(t, again) and D.stored_changed(t, again)
    again.write(spark.createDataFrame([("2016-01-31", 7, 5.0, "x", 8)], SCHEMA + ", extra int"), "merge", key="k")
    assert not D.stored_changed(t, again)


def test_other_partitioning_is_compared_by_bucket(spark, tmp_path, rows):
    a, b = table(spark, tmp_path / "a", rows), table(spark, tmp_path / "b", rows[1:], fn="substring({}, 1, 3)")
    assert diff(a, b) == [str((*rows[0], "+"))]
    with pytest.raises(ValueError, match="different columns"):
        D.stored_diff(a, table(spark, tmp_path / "c", [("2015-01-31", 1)], "date string, k bigint"))
    assert D.stored_changed(a, Table(spark, str(tmp_path / "c")))
    plain = Table(spark, str(tmp_path / "plain"))
    plain.write(spark.createDataFrame(rows, SCHEMA))
    with pytest.raises(FileNotFoundError, match="fingerprints"):
        D.stored_diff(a, plain)
