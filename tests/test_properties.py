"""Brute-force cross-checks on small random tables (hypothesis)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark import specs
from panelspark.operators import quality as Q
from panelspark.sinks.table import upsert

keys = st.one_of(st.none(), st.integers(0, 5))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(keys, st.integers(0, 9), st.sampled_from(["a", "b"])), max_size=8),
       st.dictionaries(st.integers(0, 7), st.integers(10, 19), max_size=6),
       st.lists(st.integers(10, 19), max_size=2))
def test_upsert_matches_python_merge(spark, target, source_map, null_key_values):
    source = [(k, v) for k, v in source_map.items()] + [(None, v) for v in null_key_values]
    t = spark.createDataFrame(target, "k bigint, v bigint, extra string")
    s = spark.createDataFrame(source, "k bigint, v bigint")
    got = [(r.k, r.v, r.extra) for r in upsert(t, s, ["k"]).collect()]
    # MERGE semantics in plain Python: NULL keys never match
    want = []
    src = {k: v for k, v in source if k is not None}
    for k, v, extra in target:
        want.append((k, src[k], extra) if k is not None and k in src else (k, v, extra))
    matched = {k for k, _v, _e in target if k is not None}
    want += [(k, v, None) for k, v in source if k is None or k not in matched]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or "")
    assert sorted(got, key=key) == sorted(want, key=key)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["2024-01-31", "2024-13-01", "24-01-01", "x"])),
                          st.one_of(st.none(), st.integers(0, 3)),
                          st.one_of(st.none(), st.floats(-5, 120, allow_nan=False))), max_size=12))
def test_gate_matches_python_validators(spark, rows):
    df = spark.createDataFrame(rows, "date string, region_id bigint, x double")
    spec = Q.Spec(not_null=["date", "region_id"], unique=["date", "region_id"], min_rows=5,
                  checks=[Q.date_format_check("date"), Q.range_check("x", 0, 100)])
    rep = {(r.rule, r.column): (r.violations, r.passed) for r in Q.dq_report(df, spec).collect()}
    nn_date = sum(1 for d, _r, _x in rows if d is None)
    nn_reg = sum(1 for _d, r, _x in rows if r is None)
    dups = len(rows) - len({(d, r) for d, r, _x in rows})  # a Python set: None equals None
    bad_date = sum(1 for d, _r, _x in rows if d is not None and not re.match(specs.DATE_RE, d))
    bad_x = sum(1 for _d, _r, x in rows if x is not None and (x < 0 or x > 100))
    assert rep[("not_null", "date")] == (nn_date, nn_date == 0)
    assert rep[("not_null", "region_id")] == (nn_reg, nn_reg == 0)
    assert rep[("unique", "date,region_id")] == (dups, dups == 0)
    assert rep[("valid_date", "date")] == (bad_date, bad_date == 0)
    assert rep[("in_range", "x")] == (bad_x, bad_x == 0)
    assert rep[("min_rows", None)] == (max(0, 5 - len(rows)), len(rows) >= 5)
