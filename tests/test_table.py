import pytest

from panelspark.sinks.publish import check_metadata, publish
from panelspark.sinks.table import MergeKeyError, Table
from panelspark.sources.raw import load_table


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_append_evolves_schema_and_empty_is_noop(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    t.write(spark.createDataFrame([(1, "a")], "k bigint, v string"), "append")
    t.write(spark.createDataFrame([(2, "b", 1.0)], "k bigint, v string, w double"), "append")
    assert t.write(spark.createDataFrame([], "k bigint"), "overwrite") is None
    df = t.read()
    assert rows(df, "k", "v", "w") == [(1, "a", None), (2, "b", 1.0)]
    assert t.columns() == ["k", "v", "w"]
    with pytest.raises(ValueError, match="'v'"):
        t.write(spark.createDataFrame([(3, 1)], "k bigint, v int"), "append")


def test_overwrite_replaces_rows_and_columns(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    t.write(spark.createDataFrame([(1,)], "k bigint"), "append")
    t.write(spark.createDataFrame([(9, "x")], "k bigint, s string"), "overwrite")
    assert rows(t.read(), "k") == [(9,)] and t.read().columns == ["k", "s"]


def test_merge_semantics_and_idempotence(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    t.write(spark.createDataFrame([(1, "a", "keep1"), (2, "b", "keep2")], "k bigint, v string, extra string"),
            "merge", key="k")  # creates
    src = spark.createDataFrame([(2, "B"), (3, "C")], "k bigint, v string")
    t.write(src, "merge", key="k")
    t.write(src, "merge", key="k")  # idempotent
    assert rows(t.read(), "k", "v", "extra") == [(1, "a", "keep1"), (2, "B", "keep2"), (3, "C", None)]


def test_merge_composite_key_and_duplicates(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    t.write(spark.createDataFrame([("2024-01-31", 1, 1.0)], "date string, id bigint, x double"), "merge",
            key=["date", "id"])
    t.write(spark.createDataFrame([("2024-01-31", 1, 2.0), ("2024-01-31", 2, 3.0)], "date string, id bigint, x double"),
            "merge", key=["date", "id"])
    assert rows(t.read(), "id", "x") == [(1, 2.0), (2, 3.0)]
    with pytest.raises(MergeKeyError):
        t.write(spark.createDataFrame([("d", 1, 1.0), ("d", 1, 2.0)], "date string, id bigint, x double"),
                "merge", key=["date", "id"])


def test_argument_checks(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1,)], "k bigint")
    with pytest.raises(ValueError):
        t.write(df, "upsert")
    with pytest.raises(ValueError):
        t.write(df, "merge")


def test_publish_metadata_and_load(spark, tmp_path):
    t = Table(spark, str(tmp_path / "tables" / "ds"))
    t.write(spark.createDataFrame([(1, "a")], "k bigint, v string"), "overwrite")
    with pytest.raises(ValueError):
        publish(t, {"id": "ds"})
    with pytest.raises(ValueError):
        check_metadata({"id": "ds", "title": "T", "column_descriptions": {"nope": "x"}}, ["k", "v"])
    publish(t, {"id": "ds", "title": "T", "column_descriptions": '{"k": "the key"}'})
    df = load_table(spark, str(tmp_path / "tables"), "ds")
    assert df.schema["k"].metadata["comment"] == "the key"
    with pytest.raises(FileNotFoundError):
        load_table(spark, str(tmp_path / "tables"), "absent")


def test_upsert_null_keys_never_match(spark):
    from panelspark.sinks.table import upsert
    target = spark.createDataFrame([(None, "t-null"), (1, "t1")], "k bigint, v string")
    source = spark.createDataFrame([(None, "s-null"), (1, "s1")], "k bigint, v string")
    got = sorted((r.k if r.k is not None else -1, r.v) for r in upsert(target, source, ["k"]).collect())
    assert got == [(-1, "s-null"), (-1, "t-null"), (1, "s1")]


def part_files(t):
    return {f.split("__part=")[1] for f in t.read().inputFiles()}


def test_partitioned_merge_replaces_only_touched_partitions(spark, tmp_path):
    root = str(tmp_path / "p")
    t = Table(spark, root, partition_col="date", partition_fn="substring({}, 1, 4)")
    schema = "date string, region_id bigint, v double"
    t.write(spark.createDataFrame([("2019-01-31", 1, 1.0), ("2020-01-31", 1, 2.0), ("0012-01-31", 1, 0.5), (None, 4, 4.0)], schema),
            "merge", key=["date", "region_id"])
    before, folder = part_files(t), t.folder()
    t.write(spark.createDataFrame([("2020-01-31", 1, 9.0), ("2021-01-31", 2, 3.0), (None, 4, 5.0)], schema), "merge",
            key=["date", "region_id"])
    after = part_files(t)
    kept = {f for f in before if f.startswith(("2019", "0012"))}
    assert len(kept) == 2 and kept <= after and not (before - kept) & after and t.folder() == folder
    assert {f.split("/")[0] for f in after} == {"0012", "2019", "2020", "2021", "__HIVE_DEFAULT_PARTITION__"}
    reopened = Table(spark, root)  # the partitioning comes from the definition
    assert reopened.partitioned and "__part" not in reopened.read().columns
    got = sorted(str(tuple(r)) for r in reopened.read().select("date", "region_id", "v").collect())
    want = [("0012-01-31", 1, 0.5), ("2019-01-31", 1, 1.0), ("2020-01-31", 1, 9.0), ("2021-01-31", 2, 3.0), (None, 4, 4.0), (None, 4, 5.0)]
    assert got == sorted(map(str, want))
    t.write(spark.createDataFrame([("2022-01-31", 3, 4.0)], schema), "append")
    assert t.read().count() == 7 and t.folder() == folder
    t.write(spark.createDataFrame([("2023-01-31", 3, 5.0)], schema), "overwrite")
    assert [tuple(r) for r in t.read().select("date").collect()] == [("2023-01-31",)]


def test_a_merge_brings_new_columns_to_all_partitions(spark, tmp_path):
    t = Table(spark, str(tmp_path / "n"), partition_col="date", partition_fn="substring({}, 1, 4)")
    t.write(spark.createDataFrame([("2019-01-31", 1), ("2020-01-31", 1)], "date string, k int"), "merge", key=["date", "k"])
    t.write(spark.createDataFrame([("2020-01-31", 1, "x")], "date string, k int, w string"), "merge", key=["date", "k"])
    assert sorted((r.date, r.w) for r in t.read().collect()) == [("2019-01-31", None), ("2020-01-31", "x")]


def test_partition_filter_prunes_folders(spark, tmp_path):
    t = Table(spark, str(tmp_path / "f"), partition_col="k", partition_fn="floor({} / 10)")
    t.write(spark.range(200).selectExpr("id AS k"), "append")
    got = t.read(partition=True).where("CAST(__part AS INT) BETWEEN 8 AND 12 AND k BETWEEN 85 AND 125")
    assert sorted(r.k for r in got.collect()) == list(range(85, 126))
    assert {f.split("__part=")[1].split("/")[0] for f in got.inputFiles()} <= {str(i) for i in range(20)}
    assert "PartitionFilters: [isnotnull(__part" in got._jdf.queryExecution().executedPlan().toString()


def test_the_write_observes_rows_and_nulls(spark, tmp_path):
    t = Table(spark, str(tmp_path / "o"), partition_col="d", sort_by=["v"])
    staged = t.write(spark.createDataFrame([("a", 1), ("b", None), (None, None)], "d string, v int").repartition(3))
    assert (staged.rows, staged.nulls) == (3, {"d": 1, "v": 2})


def test_partitioned_merge_with_key_outside_partition_merges_all(spark, tmp_path):
    t = Table(spark, str(tmp_path / "q"), partition_col="date", partition_fn="substring({}, 1, 4)")
    schema = "date string, k bigint, v double"
    t.write(spark.createDataFrame([("2019-01-31", 1, 1.0)], schema), "merge", key="k")
    t.write(spark.createDataFrame([("2020-01-31", 1, 2.0)], schema), "merge", key="k")  # same key, new year
    assert [tuple(r) for r in t.read().select("date", "k", "v").collect()] == [("2020-01-31", 1, 2.0)]
