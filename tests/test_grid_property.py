"""Property: join-before-melt == outer join + grain filter + dropna(all),
stated directly in pandas on small random wide panels (brute force)."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark import specs
from panelspark.plans.panels import build_panel

MONTHS = ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]
COLS = ["for_sale_inventory", "new_listings", "new_pending"]


@st.composite
def variant(draw):
    months = sorted(draw(st.sets(st.sampled_from(MONTHS), min_size=1, max_size=4)))
    regions = draw(st.lists(st.integers(1, 6), min_size=1, max_size=5, unique=True))
    rows = []
    for r in regions:
        rtype = draw(st.sampled_from(["msa", "MSA", "msa", "county"]))
        cells = [draw(st.one_of(st.none(), st.integers(0, 9).map(str), st.just("x"))) for _ in months]
        rows.append((r, r, f"R{r}", rtype, f"S{r % 3}", *cells))
    return months, rows


def reference(variants):
    """Literal semantics with pandas: melt each, outer-merge on keys, filter, dropna."""
    longs = []
    for (months, rows), col in zip(variants, COLS):
        wide = pd.DataFrame(rows, columns=["RegionID", "SizeRank", "RegionName", "RegionType", "StateName", *months])
        long = wide.melt(id_vars=["RegionID", "SizeRank", "RegionName", "RegionType", "StateName"],
                         var_name="date", value_name=col)
        longs.append(long)
    merged = longs[0]
    for long, col in zip(longs[1:], COLS[1:]):
        merged = merged.merge(long[["RegionID", "date", col]], on=["RegionID", "date"], how="outer")
    merged = merged[merged["RegionType"].str.lower() == "msa"]
    for col in COLS:
        merged[col] = pd.to_numeric(merged[col], errors="coerce")
    merged = merged.dropna(subset=COLS, how="all")
    out = set()
    for r in merged.itertuples(index=False):
        vals = tuple(None if pd.isna(getattr(r, c)) else float(getattr(r, c)) for c in COLS)
        out.add((int(r.RegionID), r.date, r.RegionName, r.StateName, *vals))
    return out


@settings(max_examples=25, deadline=None)
@given(st.lists(variant(), min_size=3, max_size=3))
def test_grid_matches_pandas_reference(spark, variants):
    # unique region ids per variant keep the reference free of merge fan-out
    frames = []
    for (months, rows), col in zip(variants, COLS):
        names = ["RegionID", "SizeRank", "RegionName", "RegionType", "StateName", *months]
        schema = ", ".join(f"`{c}` {'bigint' if c in ('RegionID', 'SizeRank') else 'string'}" for c in names)
        frames.append((spark.createDataFrame(rows, schema), col))
    got = build_panel(frames, specs.INVENTORY, "metro", check_empty=False)
    rows = {(r.region_id, r.date, r.region_name, r.state_code or None, *(r[c] for c in COLS)) for r in got.collect()}
    want = {(a, b, c, d or None, *v) for a, b, c, d, *v in reference(variants)}
    assert rows == want
