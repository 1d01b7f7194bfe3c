import pytest

from panelspark import specs
from panelspark.operators.quality import QualityError
from panelspark.plans.panels import run_family, run_panel
from panelspark.sinks.table import Table
from panelspark.sources.raw import landing_path
from panelspark.sources.wide_csv import read_wide_csv

HEAD = "RegionID,SizeRank,RegionName,RegionType,StateName"


def land(tmp_path, grain, files):
    root = tmp_path / "raw"
    for prefix, text in files.items():
        root.mkdir(exist_ok=True)
        (root / f"{prefix}_{grain}.csv").write_text(text)
    return str(root)


def test_family_end_to_end_and_rerun_is_idempotent(spark, tmp_path):
    raw = land(tmp_path, "metro", {
        "inventory_for_sale": f"{HEAD},2020-01-31,2020-02-29\n1,1,A,msa,CA,5,6\n2,2,B,msa,NY,,7\n9,0,US,country,,100,100\n",
        "new_listings": f"{HEAD},2020-01-31,2020-02-29\n1,1,A,msa,CA,1,\n3,3,C,msa,TX,8,8\n",
        # new_pending missing: the variant is skipped
    })
    out = str(tmp_path / "tables")
    ledger = str(tmp_path / "ledgers")
    for _ in range(2):  # merge on (date, region_id): a rerun does not duplicate
        res = run_family(spark, "inventory", raw, out, grains=["metro"], min_rows=1, ledger_root=ledger)
    df = res["metro"].table.read()
    got = sorted((r.date, r.region_id, r.region_name, r.state_code, r.for_sale_inventory, r.new_listings)
                 for r in df.collect())
    assert got == [("2020-01-31", 1, "A", "CA", 5.0, 1.0), ("2020-02-29", 1, "A", "CA", 6.0, None),
                   ("2020-02-29", 2, "B", "NY", 7.0, None)]
    assert "new_pending" not in df.columns
    meta = res["metro"].table.metadata()
    assert meta["id"] == "inventory_metro" and "new_pending" not in meta["column_descriptions"]
    assert spark.read.json(f"{ledger}/data_outputs").count() == 2


def test_gate_failure_commits_nothing(spark, tmp_path):
    raw = land(tmp_path, "metro", {"zori": f"{HEAD},2020-01-31\n1,1,A,msa,CA,50\n"})  # rent < 100
    fam = specs.RENT
    frames = [(read_wide_csv(spark, landing_path(raw, "zori", "metro")), "rent")]
    with pytest.raises(QualityError):
        run_panel(spark, fam, "metro", frames, str(tmp_path / "tables"), min_rows=1)
    assert not Table(spark, str(tmp_path / "tables" / "rent_metro")).exists()


def test_duplicate_region_in_later_variant_fails_uniqueness(spark, tmp_path):
    raw = land(tmp_path, "zip", {
        "inventory_for_sale": f"{HEAD},2020-01-31\n1,1,00501,zip,NY,5\n",
        "new_listings": f"{HEAD},2020-01-31\n1,1,00501,zip,NY,1\n1,1,00501,zip,NY,2\n",
    })
    with pytest.raises(QualityError) as err:
        run_family(spark, "inventory", raw, str(tmp_path / "tables"), grains=["zip"], min_rows=1)
    assert any(f["rule"] == "unique" for f in err.value.failures)


def test_state_grain_drops_state_code(spark, tmp_path):
    raw = land(tmp_path, "state", {"zori": f"{HEAD},2020-01-31\n1,1,California,state,CA,1500\n"})
    res = run_family(spark, "rent", raw, str(tmp_path / "tables"), grains=["state"], min_rows=1)
    assert res["state"].table.read().columns == ["region_id", "region_name", "date", "rent"]


def test_run_all_switches(spark, tmp_path):
    from panelspark.plans.panels import run_all
    raw = land(tmp_path, "metro", {"zori": f"{HEAD},2020-01-31\n1,1,A,msa,CA,1500\n"})
    out = run_all(spark, raw, str(tmp_path / "t"), transform=False)
    assert out["ingested"] == 1 and out["tables"] == {}
    out = run_all(spark, raw, str(tmp_path / "t"), ingest=False, families=["rent"], grains=["metro"], min_rows=1)
    assert out["ingested"] == 0 and list(out["tables"]) == [("rent", "metro")]


def test_duplicate_outside_the_grid_is_not_an_error(spark, tmp_path):
    raw = land(tmp_path, "zip", {
        "inventory_for_sale": f"{HEAD},2020-01-31\n1,1,00501,zip,NY,5\n",
        "new_listings": f"{HEAD},2020-01-31\n1,1,00501,zip,NY,1\n7,7,00777,zip,NY,2\n7,7,00777,zip,NY,3\n",
    })
    res = run_family(spark, "inventory", raw, str(tmp_path / "tables"), grains=["zip"], min_rows=1)
    assert [(r.region_id, r.new_listings) for r in res["zip"].table.read().collect()] == [(1, 1.0)]


def test_full_outer_path_catches_pair_fanout(spark, tmp_path):
    head = "RegionID,SizeRank,RegionName,StateName"
    raw = land(tmp_path, "zip", {
        "inventory_for_sale": f"{head},2020-01-31\n1,1,00501,NY,5\n",
        "new_listings": f"{head},2020-01-31\n1,1,00501,NY,1\n1,1,00501,NY,2\n",
    })
    with pytest.raises(QualityError):
        run_family(spark, "inventory", raw, str(tmp_path / "tables"), grains=["zip"], min_rows=1)
