"""Property: header-grouped CSV read + melt + coercion == pandas read_csv +
melt + to_numeric (the source's own parsing), on random tricky files."""

import csv
import io
import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark import specs
from panelspark.functions.scalars import to_double
from panelspark.operators.reshape import melt
from panelspark.sources.wide_csv import read_wide_csv

NAMES = ["00501", "New York, NY", 'say "hi", ok', "NA", "", "None", "n/a", "Plain"]
# pandas infers types for id columns other than RegionName (a numeric-looking
# StateName would become a number); panelspark keeps every id column as text,
# a documented deviation, so state names here are non-numeric like real ones.
STATES = ["CA", "New York, NY", 'say "hi", ok', "NA", "", "None", "n/a"]
CELLS = ["1", "2.5", "", "NA", "abc", "1d", "inf", "-3", "NaN", "1e3", " 7 ", "null"]
MONTHS = ["2024-01-31", "2024-02-29", "2024-03-31"]


def test_na_tokens_are_pandas_defaults():
    from pandas._libs.parsers import STR_NA_VALUES
    assert set(specs.NA_TOKENS) == set(STR_NA_VALUES)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(NAMES), st.sampled_from(STATES),
                          st.lists(st.sampled_from(CELLS), min_size=3, max_size=3)), min_size=1, max_size=6))
def test_reader_matches_pandas(spark, tmp_path_factory, rows):
    path = tmp_path_factory.mktemp("csvprop") / "v.csv"
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(["RegionID", "RegionName", "StateName", *MONTHS])
    for i, (name, state, cells) in enumerate(rows):
        w.writerow([i, name, state, *cells])
    path.write_text(buf.getvalue())

    pdf = pd.read_csv(path, dtype={"RegionName": str})
    long = pdf.melt(id_vars=["RegionID", "RegionName", "StateName"], var_name="date", value_name="v")
    long["v"] = pd.to_numeric(long["v"], errors="coerce")

    def norm_s(x):
        return None if (x is None or (isinstance(x, float) and math.isnan(x))) else str(x)

    def norm_v(x):
        return None if pd.isna(x) else float(x)

    want = {(int(r.RegionID), r.date, norm_s(r.RegionName), norm_s(r.StateName), norm_v(r.v))
            for r in long.itertuples(index=False)}

    df = read_wide_csv(spark, str(path))
    got_df = melt(df, "v").withColumn("v", to_double("v"))
    got = {(r.RegionID, r.date, r.RegionName, r.StateName, r.v) for r in got_df.collect()}
    assert got == want
