import pytest
from pyspark.sql import functions as F

from panelspark.operators.standardize import sorted_proof, write_sorted
from panelspark.sources.raw import scan_raw_variant, typed_fields


def test_written_ranges_follow_each_other(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("a"), F.when(F.col("id") % 11 > 0, F.concat(F.lit("r"), F.col("id") % 50)).alias("b"))
    write_sorted(df.repartition(6), f"{tmp_path}/s", ["a", "b"], files=5)
    proof = sorted_proof(spark, f"{tmp_path}/s", ["a", "b"]).first()
    assert (proof.rows, proof.unordered_files, proof.overlaps) == (5000, 0, 0) and proof.files > 1


def test_the_proof_fails_for_other_orders(spark, tmp_path):
    df = spark.range(1000).select("id")
    df.repartition(4).sortWithinPartitions("id").write.parquet(f"{tmp_path}/overlap")
    assert sorted_proof(spark, f"{tmp_path}/overlap", ["id"]).first().overlaps > 0
    df.repartitionByRange(4, "id").sortWithinPartitions(F.desc("id")).write.parquet(f"{tmp_path}/falling")
    proof = sorted_proof(spark, f"{tmp_path}/falling", ["id"]).first()
    assert proof.overlaps == 0 and proof.unordered_files == proof.files > 1
    nulls = spark.createDataFrame([(None,), (1,)], "id int").coalesce(1)
    nulls.write.parquet(f"{tmp_path}/nulls_first")
    assert sorted_proof(spark, f"{tmp_path}/nulls_first", ["id"]).first().unordered_files == 1
    df.limit(0).write.parquet(f"{tmp_path}/none")
    assert tuple(sorted_proof(spark, f"{tmp_path}/none", ["id"]).first()) == (0, 0, 0, 0)


def test_a_field_that_changes_its_type_loses_nothing(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.json").write_text("\n".join([
        '{"id": 1, "v": 5}', '{"id": 2, "v": "x"}', '{"id": 3, "v": {"deep": [1, 2]}}', '{"id": 4, "v": null}', '{"id": 5}', '{"id": 6, "v": "7"}', '{"id": "text"}']))
    rows = typed_fields(scan_raw_variant(spark, str(tmp_path), "a"), {"id": ("$.id", "int"), "v": ("$.v", "int")}).collect()
    got = {r.id: (r.v, r.v_other) for r in rows}
    assert got == {1: (5, None), 2: (None, '"x"'), 3: (None, '{"deep":[1,2]}'), 4: (None, None), 5: (None, None), 6: (7, None), None: (None, None)}
    assert [r.id_other for r in rows if r.id is None] == ['"text"']
    with pytest.raises(FileNotFoundError):
        scan_raw_variant(spark, str(tmp_path), "absent")
