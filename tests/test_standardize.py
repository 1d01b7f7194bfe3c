from panelspark.operators import standardize as ST


def test_filter_grain_case_and_nulls(spark):
    df = spark.createDataFrame([(1, "MSA"), (2, "msa"), (3, None), (4, "country")], "RegionID bigint, RegionType string")
    assert sorted(r.RegionID for r in ST.filter_grain(df, "metro").collect()) == [1, 2]


def test_filter_grain_without_column_is_noop(spark):
    df = spark.createDataFrame([(1,)], "RegionID bigint")
    assert ST.filter_grain(df, "metro").count() == 1


def test_state_code_rules(spark):
    df = spark.createDataFrame([(1, None), (2, "CA")], "region_id bigint, state_code string")
    assert [r.state_code for r in ST.state_code_fill(df, "zip").orderBy("region_id").collect()] == ["", "CA"]
    assert "state_code" not in ST.state_code_fill(df, "state").columns


def test_rename_drop_and_standardize(spark):
    df = spark.createDataFrame(
        [(1, 5, "A", "msa", None, "2024-01-31", "1.5", None), (2, 6, "B", "msa", "NY", "2024-01-31", None, None)],
        "RegionID bigint, SizeRank bigint, RegionName string, RegionType string, StateName string, "
        "date string, a string, b string")
    out = ST.standardize(df, "metro", ["a", "b"])
    assert out.columns == ["region_id", "region_name", "state_code", "date", "a", "b"]
    rows = out.collect()
    assert len(rows) == 1 and rows[0].state_code == "" and rows[0].a == 1.5  # all-null row dropped


def test_sort_nulls_last(spark):
    df = spark.createDataFrame([("2024-01-31", None), ("2024-01-31", "A"), ("2023-12-31", "Z")],
                               "date string, region_name string")
    assert [r.region_name for r in ST.sort_output(df).collect()] == ["Z", "A", None]


def test_date_normalize(spark):
    df = spark.createDataFrame([("2024-01-05 00:00:00",), ("2024-1-5",)], "date string")
    assert [r.date for r in ST.date_normalize(df).collect()] == ["2024-01-05", "2024-01-05"]
