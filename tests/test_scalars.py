import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark import specs
from panelspark.functions import scalars as S

SAMPLES = ["2024", "2024-Q1", "2024-Q5", "2024-01", "2024-13", "2024-W01", "2024-W54", "2024-02-30", "2024-1-1",
           "24", "abcd", "2024-01-31\n", "", None]


def test_date_patterns_match_python_re(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "v string")
    fns = {specs.YEAR_RE: S.fn_is_year, specs.QUARTER_RE: S.fn_is_quarter, specs.MONTH_RE: S.fn_is_month,
           specs.WEEK_RE: S.fn_is_week, specs.DATE_RE: S.fn_is_date}
    for pattern, fn in fns.items():
        got = [r[0] for r in df.select(fn("v")).collect()]
        want = [True if v is None else bool(re.match(pattern, v)) for v in SAMPLES]
        assert got == want, pattern


def test_pattern_is_start_anchored(spark):
    df = spark.createDataFrame([("Brand#12",), ("xBrand#1",), (None,)], "v string")
    assert [r[0] for r in df.select(S.fn_matches_pattern("v", "Brand#1")).collect()] == [True, False, True]


def test_lengths_count_code_points(spark):
    df = spark.createDataFrame([("héllo",), ("日本",)], "v string")
    assert [r[0] for r in df.select(S.fn_exact_length("v", 5)).collect()] == [True, False]
    assert [r[0] for r in df.select(S.fn_max_length("v", 2)).collect()] == [False, True]


def test_numeric_predicates(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (50.0,), (101.0,), (None,)], "x double")
    got = df.select(S.fn_positive("x"), S.fn_positive("x", allow_zero=False), S.fn_percentage("x"),
                    S.fn_in_range("x", lo=0), S.fn_in_set("x", [0.0, 50.0])).collect()
    assert [tuple(r) for r in got] == [
        (True, False, True, True, True), (False, False, False, False, False), (True, True, True, True, True),
        (True, True, False, True, False), (True, True, True, True, True)]


def test_substr_year(spark):
    df = spark.createDataFrame([("2024-05-01",), ("ab",)], "v string")
    assert [r[0] for r in df.select(S.fn_substr_year("v")).collect()] == [2024, None]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.eE+-infatyNIdfx ", max_size=8), min_size=1, max_size=20))
def test_to_double_matches_regex_spec(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    ref = F.when(F.col("v").rlike(S.NUMERIC_TEXT_RE),
                 F.nanvl(F.trim("v").try_cast("double"), F.lit(None).cast("double")))
    for r in df.select(S.to_double("v").alias("a"), ref.alias("b")).collect():
        assert r.a == r.b or (r.a is None and r.b is None)
