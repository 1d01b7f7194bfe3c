import pytest
from pyspark.sql import functions as F

from panelspark import specs
from panelspark.operators import reshape as R
from panelspark.operators.standardize import standardize, to_numeric_coerce
from panelspark.plans.panels import build_panel

HEAD = "RegionID,SizeRank,RegionName,RegionType,StateName"


def wide(spark, rows, months, with_type=True):
    cols = ["RegionID", "SizeRank", "RegionName"] + (["RegionType"] if with_type else []) + ["StateName"] + months
    schema = ", ".join(f"`{c}` {'bigint' if c in ('RegionID', 'SizeRank') else 'string'}" for c in cols)
    return spark.createDataFrame(rows, schema)


def test_melt_keeps_nulls_and_normalises_headers(spark):
    df = wide(spark, [(1, 1, "A", "msa", "CA", "1", None), (2, 2, "B", "msa", None, None, "2.5")],
              ["2024-01-31", "2024-02-29"])
    long = R.melt(df, "v").orderBy("RegionID", "date").collect()
    assert [(r.RegionID, r.date, r.v) for r in long] == [
        (1, "2024-01-31", "1"), (1, "2024-02-29", None), (2, "2024-01-31", None), (2, "2024-02-29", "2.5")]


def test_malformed_header_raises(spark):
    df = wide(spark, [(1, 1, "A", "msa", "CA", "1")], ["2024-01-312"])
    with pytest.raises(ValueError):
        R.melt(df, "v")


def test_grid_is_first_variant(spark):
    # variant 1: Feb..Mar, regions 1,2 ; variant 2: Jan..Feb, regions 2,3
    v1 = wide(spark, [(1, 1, "A", "Msa", "CA", "10", "11"), (2, 2, "B", "msa", "NY", "20", None)],
              ["2024-02-29", "2024-03-31"])
    v2 = wide(spark, [(2, 2, "B2", "msa", "NY", "200", "201"), (3, 3, "C", "msa", "TX", "300", "301")],
              ["2024-01-31", "2024-02-29"])
    out = R.melt_multi([(v1, "a"), (v2, "b")], grain_filter="msa", coerce=True)
    rows = sorted((r.RegionID, r.date, r.a, r.b, r.RegionName) for r in out.collect())
    # months only in variant 2 (Jan) and regions only in variant 2 (3) are lost (D2);
    # region 1 is missing from variant 2 yet keeps its rows (arrays_zip trap)
    assert rows == [
        (1, "2024-02-29", 10.0, None, "A"), (1, "2024-03-31", 11.0, None, "A"),
        (2, "2024-02-29", 20.0, 201.0, "B"), (2, "2024-03-31", None, None, "B"),
    ]
    raw = R.melt_multi([(v1, "a"), (v2, "b")], grain_filter="msa", coerce=False)
    assert dict(raw.dtypes)["a"] == "string"


def test_grid_equals_outer_join_filter_dropna(spark):
    v1 = wide(spark, [(1, 1, "A", "msa", "CA", "1", None), (2, 2, "B", "zip", "NY", "2", "3"),
                      (4, 4, "D", "msa", None, None, None)], ["2024-01-31", "2024-02-29"])
    v2 = wide(spark, [(1, 1, "A", "msa", "CA", None, "5"), (3, 3, "C", "msa", "TX", "6", "7")],
              ["2024-01-31", "2024-02-29"])
    fam = specs.INVENTORY
    cols = ["for_sale_inventory", "new_listings"]
    grid = build_panel([(v1, cols[0]), (v2, cols[1])], fam, "metro", check_empty=False)
    assert grid is not None
    # literal semantics: full outer join of long frames, then the grain filter, then dropna(all)
    l1, l2 = R.melt(v1, cols[0]), R.melt(v2, cols[1])
    outer = R.merge_variants([(l1, cols[0]), (l2, cols[1])])
    literal = standardize(outer, "metro", fam.value_columns)
    key = lambda df: sorted(tuple(r) for r in df.select("region_id", "date", *cols).collect())
    assert key(grid) == key(literal)


def test_later_variant_duplicate_key_fans_out(spark):
    v1 = wide(spark, [(1, 1, "A", "msa", "CA", "1")], ["2024-01-31"])
    v2 = wide(spark, [(1, 1, "A", "msa", "CA", "2"), (1, 1, "A", "msa", "CA", "3")], ["2024-01-31"])
    out = R.melt_multi([(v1, "a"), (v2, "b")], grain_filter="msa")
    assert out.count() == 2  # caught later by the uniqueness gate


def test_no_region_type_uses_full_outer(spark):
    v1 = wide(spark, [(1, 1, "A", "CA", "1")], ["2024-01-31"], with_type=False)
    v2 = wide(spark, [(2, 2, "B", "NY", "2")], ["2024-01-31"], with_type=False)
    out = build_panel([(v1, "for_sale_inventory"), (v2, "new_listings")], specs.INVENTORY, "metro",
                      check_empty=False, check_keys=True)
    rows = sorted((r.region_id, r.region_name) for r in out.collect())
    assert rows == [(1, "A"), (2, None)]  # outer rows survive with null names (D3)


def test_union_grid_keeps_everything(spark):
    v1 = wide(spark, [(1, 1, "A", "msa", "CA", "1")], ["2024-02-29"])
    v2 = wide(spark, [(3, 3, "C", "msa", "TX", "6")], ["2024-01-31"])
    out = R.merge_variants_union([(v1, "a"), (v2, "b")], "msa")
    rows = sorted((r.RegionID, r.date, r.RegionName) for r in out.where(
        F.col("a").isNotNull() | F.col("b").isNotNull()).collect())
    assert rows == [(1, "2024-02-29", "A"), (3, "2024-01-31", "C")]


def test_numeric_coercion_after_melt(spark):
    df = wide(spark, [(1, 1, "A", "msa", "CA", "abc", "1d"), (2, 2, "B", "msa", "CA", "NaN", " inf ")],
              ["2024-01-31", "2024-02-29"])
    long = to_numeric_coerce(R.melt(df, "v"), ["v"])
    vals = sorted((r.RegionID, r.date, r.v) for r in long.collect())
    assert vals == [(1, "2024-01-31", None), (1, "2024-02-29", None),
                    (2, "2024-01-31", None), (2, "2024-02-29", float("inf"))]


def test_merge_variants_matches_null_keys_like_pandas(spark):
    a = spark.createDataFrame([(None, "2024-01-31", "A", "1"), (1, "2024-01-31", "B", "2")],
                              "RegionID bigint, date string, RegionName string, x string")
    b = spark.createDataFrame([(None, "2024-01-31", "5"), (2, "2024-01-31", "6")], "RegionID bigint, date string, y string")
    rows = sorted(((r.RegionID or -1), r.RegionName or "", r.x or "", r.y or "")
                  for r in R.merge_variants([(a, "x"), (b, "y")]).collect())
    assert rows == [(-1, "A", "1", "5"), (1, "B", "2", ""), (2, "", "", "6")]
