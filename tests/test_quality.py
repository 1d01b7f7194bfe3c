import pytest

from panelspark import specs
from panelspark.functions import scalars as S
from panelspark.operators import quality as Q


def report(df, spec):
    return {(r.rule, r.column): (r.violations, r.passed) for r in Q.dq_report(df, spec).collect()}


def test_one_pass_report(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "a", -1.0), (None, None, 500.0), (None, "b", None)],
                               "k bigint, s string, x double")
    spec = Q.Spec(columns={"k": "int", "s": "string", "x": "int"}, not_null=["k", "s"], unique=["k", "s"],
                  min_rows=5, checks=[Q.range_check("x", 0, 100), Q.positive_check("x")])
    rep = report(df, spec)
    assert rep[("column_type", "k")] == (0, True)
    assert rep[("column_type", "x")] == (1, False)  # 'int' is not in 'double'
    assert rep[("not_null", "k")] == (2, False) and rep[("not_null", "s")] == (1, False)
    assert rep[("unique", "k,s")] == (1, False)  # (1,a) twice; (NULL,NULL) and (NULL,b) differ
    assert rep[("min_rows", None)] == (1, False)
    assert rep[("in_range", "x")] == (2, False) and rep[("positive", "x")] == (1, False)


def test_null_keys_are_values(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k bigint")
    assert report(df, Q.Spec(unique="k"))[("unique", "k")] == (1, False)


def test_validate_raises_with_samples(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)], "x double")
    with pytest.raises(Q.QualityError) as err:
        Q.validate(df, Q.Spec(checks=[Q.range_check("x", hi=10)]))
    assert err.value.samples[("in_range", "x")] == [11.0, 12.0, 13.0, 14.0, 15.0] or \
        len(err.value.samples[("in_range", "x")]) == 5


def test_year_bounds_and_missing_column(spark):
    df = spark.createDataFrame([("2009-12-31",), ("2024-01-31",)], "date string")
    rep = report(df, Q.Spec(checks=[Q.YearBounds("date", 2010, 2030), Q.range_check("nope", 0, 1)]))
    assert rep[("year_bounds", "date")] == (1, False)
    assert rep[("in_range", "nope")] == (1, False)


def test_family_spec_passes_on_clean_panel(spark):
    df = spark.createDataFrame([("2020-01-31", 1, "A", "CA", 1500.0), ("2020-02-29", 1, "A", "CA", 1600.0)],
                               "date string, region_id bigint, region_name string, state_code string, rent double")
    rows = Q.validate(df, Q.family_spec(specs.RENT, df, "metro", min_rows=1))
    assert all(r.passed for r in rows)


def test_rent_must_be_positive(spark):
    df = spark.createDataFrame([("2020-01-31", 1, "A", "CA", 0.0)],
                               "date string, region_id bigint, region_name string, state_code string, rent double")
    with pytest.raises(Q.QualityError):
        Q.validate(df, Q.family_spec(specs.RENT, df, "metro", min_rows=1))


def test_violation_examples_and_bounds(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    ex = Q.violation_examples(df, Q.RowCheck("lt5", "x", S.fn_in_range("x", hi=4)), 3).collect()
    assert [(r.violations, r.rank, r.value) for r in ex] == [(5, 1, 5.0), (5, 2, 6.0), (5, 3, 7.0)]
    b = Q.bounds_report(df, {"x": (0, 5)}).collect()[0]
    assert (b.min_v, b.max_v, b.passed) == (0.0, 9.0, False)


def test_in_set_violations_join(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    allowed = spark.createDataFrame([("a",)], "x string")
    assert [r.v for r in Q.in_set_violations(df, "v", allowed).collect()] == ["b"]
