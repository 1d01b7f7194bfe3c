import json

import pytest

from panelspark.plans.panels import landed_tables, read_manifest, run_all
from panelspark.sources.catalog import catalog_manifest, listing, pending, pending_files
from panelspark.sources.raw import landed_metrics, landing_path
from panelspark.streaming.ingest import ingest_incremental

HEAD = "RegionID,SizeRank,RegionName,RegionType,StateName,2024-01-31"
KIND = {"metro": "msa"}


def land(folder, name, value, region=1, text=None):
    folder.mkdir(exist_ok=True)
    grain = name.rsplit("_", 1)[1]
    (folder / f"{name}.csv").write_text(text or f"{HEAD}\n{region},1,A,{KIND.get(grain, grain)},CA,{value}\n")


def test_layout_names_metric_and_grain():
    assert landing_path("s3a://b/raw/", "zori", "zip") == "s3a://b/raw/zori_zip.csv"
    paths = ["/r/zori_zip.csv", "/r/new_listings_metro.csv/part-0.csv", "/r/zori_planet.csv", "/r/zip/metric=zori/part-0.csv"]
    found, other = landed_metrics(paths, ["zori", "new_listings"], ["zip", "metro"])
    assert found == {("zori", "zip"): [paths[0]], ("new_listings", "metro"): [paths[1]]} and other == sorted(paths[2:])
    assert landed_tables(paths)[0] == {("rent", "zip"): [paths[0]], ("inventory", "metro"): [paths[1]]}


def test_run_all_reads_the_sources_names_and_reports_unknown_files(spark, tmp_path):
    raw = tmp_path / "raw"
    land(raw, "zori_metro", 1500)
    land(raw, "zori_planet", 1)
    with pytest.warns(UserWarning, match="zori_planet"):
        out = run_all(spark, str(raw), str(tmp_path / "t"), min_rows=1)
    assert out["ingested"] == 1 and list(out["tables"]) == [("rent", "metro")]
    assert [p.rsplit("/", 1)[1] for p in out["unknown"]] == ["zori_planet.csv"]
    with pytest.warns(UserWarning, match="zori_planet"):
        assert run_all(spark, str(raw), str(tmp_path / "t"), min_rows=1)["tables"] == {}


def test_the_stream_rebuilds_what_landed_and_a_bad_file_stops_no_other(spark, tmp_path):
    raw, tables, ledger = tmp_path / "raw", str(tmp_path / "t"), str(tmp_path / "ledger")
    run = lambda: ingest_incremental(spark, str(raw), tables, str(tmp_path / "ck"), ledger_root=ledger, min_rows=1)
    land(raw, "zori_metro", 1500)
    land(raw, "zori_zip", 900)
    land(raw, "new_listings_metro", 3, text=f"{HEAD}\n1,1,A,msa,CA,3,surplus\n")  # malformed
    first = run()
    assert set(first["tables"]) == {("rent", "metro"), ("rent", "zip")} and first["files"] == 2
    assert list(first["errors"]) == [("inventory", "metro")]
    logged = [r.asDict() for r in spark.read.json(f"{ledger}/errors").collect()]
    assert [json.loads(r["context"])["files"][0].rsplit("/", 1)[1] for r in logged] == ["new_listings_metro.csv"]
    assert "malformed record" in logged[0]["message"] and set(logged[0]) == {"timestamp", "run_id", "error_type", "message", "context", "traceback"}
    assert read_manifest(spark, tables).count() == 2

    second = run()  # nothing new: only the failed table is tried again
    assert second["tables"] == {} and list(second["errors"]) == [("inventory", "metro")]
    land(raw, "new_listings_metro", 4)  # mended in place
    land(raw, "zori_city", 700)
    third = run()
    assert set(third["tables"]) == {("inventory", "metro"), ("rent", "city")} and not third["errors"]
    assert run() == {"files": 0, "tables": {}, "errors": {}, "unknown": []}
    assert run_all(spark, str(raw), tables, min_rows=1)["tables"] == {}  # one manifest for both
    land(raw, "zori_zip", 1000)  # refreshed in place
    assert [r.rent for r in run()["tables"][("rent", "zip")].table.read().collect()] == [1000.0]


def test_manifest_pending_on_path_size_mtime(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    (src / "a.csv").write_text("x\n1\n")
    done = listing(spark, str(src))
    assert pending_files(spark, str(src), done).count() == 0
    (src / "a.csv").write_text("x\n1\n2\n")  # refreshed in place
    assert pending_files(spark, str(src), done).count() == 1
    assert pending_files(spark, str(src), done, once=True).count() == 0


def test_catalog_manifest(spark):
    cat = catalog_manifest(spark)
    assert cat.count() == 105
    row = cat.where("key = 'zori_zip'").first()
    assert row.path == "zori/Zip_zori_uc_sfrcondomfr_sm_sa_month.csv"
    done = cat.where("grain = 'metro'").select("key")
    assert pending(cat, done, "key").count() == 84
