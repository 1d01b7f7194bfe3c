import pytest

from panelspark import specs
from panelspark.operators.reshape import melt
from panelspark.plans.panels import build_panel
from panelspark.sources.wide_csv import read_wide_csv

HEAD = "RegionID,SizeRank,RegionName,RegionType,StateName"


def test_headers_grouped_not_positional(spark, tmp_path):
    d = tmp_path / "v"
    d.mkdir()
    (d / "a.csv").write_text(f"{HEAD},2024-02-29,2024-03-31\n1,1,A,msa,CA,2,3\n")
    (d / "b.csv").write_text(f"{HEAD},2024-01-31,2024-02-29\n2,2,B,msa,NY,10,20\n")
    df = read_wide_csv(spark, str(d))
    vals = {(r.RegionID, r.date): r.v for r in melt(df, "v").collect()}
    assert vals[(1, "2024-02-29")] == "2" and vals[(1, "2024-01-31")] is None
    assert vals[(2, "2024-01-31")] == "10" and vals[(2, "2024-02-29")] == "20"


def test_zip_quotes_and_na_tokens(spark, write_csv):
    p = write_csv("zip.csv", (
        f'{HEAD},2024-01-31\n'
        '1,1,00501,zip,NY,1.5\n'
        '2,2,"New York, NY",zip,NA,2\n'
        '3,3,"say ""hi"", ok",zip,,abc\n'))
    df = read_wide_csv(spark, p)
    rows = {r.RegionID: r for r in df.collect()}
    assert rows[1].RegionName == "00501"
    assert rows[2].RegionName == "New York, NY" and rows[2].StateName is None
    assert rows[3].RegionName == 'say "hi", ok' and rows[3].StateName is None
    assert dict(df.dtypes)["RegionID"] == "bigint"


def test_duplicate_month_header_raises(spark, write_csv):
    p = write_csv("dup.csv", f"{HEAD},2024-01-31,2024-01-31\n1,1,A,msa,CA,1,2\n")
    with pytest.raises(ValueError):
        read_wide_csv(spark, p)


def test_header_only_file_is_empty_variant(spark, write_csv):
    p = write_csv("empty.csv", f"{HEAD},2024-01-31\n")
    assert read_wide_csv(spark, p) is None
    assert read_wide_csv(spark, write_csv("zero.csv", "")) is None


def test_missing_first_variant_is_skipped(spark, write_csv):
    p = write_csv("v2.csv", f"{HEAD},2024-01-31\n1,1,A,msa,CA,7\n")
    panel = build_panel([(None, "for_sale_inventory"), (read_wide_csv(spark, p), "new_listings")],
                        specs.INVENTORY, "metro")
    rows = panel.collect()
    assert len(rows) == 1 and rows[0].new_listings == 7.0 and "for_sale_inventory" not in panel.columns


def test_first_variant_with_foreign_grain_only_empties_result(spark, write_csv):
    a = write_csv("a.csv", f"{HEAD},2024-01-31\n1,1,A,county,CA,1\n")
    b = write_csv("b.csv", f"{HEAD},2024-01-31\n1,1,A,msa,CA,2\n")
    panel = build_panel([(read_wide_csv(spark, a), "for_sale_inventory"), (read_wide_csv(spark, b), "new_listings")],
                        specs.INVENTORY, "metro")
    assert panel.count() == 0  # D1: "non-empty" is judged before the grain filter


def test_blank_header_is_an_id_column(spark, write_csv):
    p = write_csv("blank.csv", f"{HEAD},,2024-01-31\n1,1,A,msa,CA,x,5\n")
    df = read_wide_csv(spark, p)
    assert "_c5" in df.columns
    long = melt(df, "v").collect()
    assert [(r.RegionID, r._c5, r.date, r.v) for r in long] == [(1, "x", "2024-01-31", "5")]
