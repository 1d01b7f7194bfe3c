"""Behaviour outside the clean fixture: odd CSV text, empty panels, join and gate plans, incremental runs, upsert."""

import pytest
from pyspark.sql import functions as F

from panelspark import specs
from panelspark.operators import ledgers, quality
from panelspark.operators.reshape import melt, melt_multi, merge_variants, merge_variants_packed
from panelspark.operators.standardize import sort_output
from panelspark.plans.panels import PanelErrors, run_all, run_family
from panelspark.session import workspace
from panelspark.sinks.publish import check_metadata
from panelspark.sinks.table import Table, upsert
from panelspark.sources import files
from panelspark.sources.raw import scan_text
from panelspark.sources.wide_csv import read_wide_csv

HEAD = "RegionID,SizeRank,RegionName,RegionType,StateName"


def land(tmp_path, grain, texts):
    for prefix, text in texts.items():
        (tmp_path / "raw").mkdir(exist_ok=True)
        (tmp_path / "raw" / f"{prefix}_{grain}.csv").write_text(text, encoding="utf-8")
    return str(tmp_path / "raw")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- CSV text ---------------------------------------------------------------------
def test_quoted_line_breaks_blank_lines_and_bom(spark, write_csv):
    p = write_csv("v.csv", f'﻿\n\n{HEAD},2024-01-31\n\n1,1,"A\nB ""x"", C",msa,CA,1\n\n2,2,D,msa,NY,2\n')
    rows = {r.RegionID: r for r in read_wide_csv(spark, p).collect()}
    assert rows[1].RegionName == 'A\nB "x", C' and rows[1]["2024-01-31"] == "1" and rows[2]["2024-01-31"] == "2"


@pytest.mark.parametrize("extra", ["9,10,11", "9,10,", '9,10,"a,b"'])
def test_surplus_fields_raise_and_missing_ones_are_null(spark, write_csv, extra):
    short = write_csv("s.csv", f"{HEAD},2024-01-31,2024-02-29\n1,1,A,msa,CA,5\n")
    assert [(r["2024-01-31"], r["2024-02-29"]) for r in read_wide_csv(spark, short).collect()] == [("5", None)]
    long = write_csv("l.csv", f"{HEAD},2024-01-31,2024-02-29\n1,1,A,msa,CA,5,6\n2,2,B,msa,NY,{extra}\n")
    with pytest.raises(Exception, match="malformed record"):
        melt(read_wide_csv(spark, long), "v").count()


def test_single_line_reader_refuses_a_split_record(spark, write_csv):
    p = write_csv("m.csv", f'{HEAD},2024-01-31\n1,1,"A\nB",msa,CA,1\n2,2,C,msa,NY,2\n')
    with pytest.raises(Exception, match="malformed record"):
        read_wide_csv(spark, p, multi_line=False).collect()


@pytest.mark.parametrize("text", ["", "\n\n", f"{HEAD},2024-01-31\n\n\n", f"﻿{HEAD},2024-01-31\n", f"{HEAD}\n1,1,A,msa,CA\n"])
def test_empty_first_variant_gives_way_to_the_next(spark, tmp_path, text):
    raw = land(tmp_path, "metro", {"inventory_for_sale": text, "new_listings": f"{HEAD},2024-01-31\n1,1,A,msa,CA,7\n"})
    res = run_family(spark, "inventory", raw, str(tmp_path / "t"), grains=["metro"], min_rows=1)
    assert [(r.region_id, r.new_listings) for r in res["metro"].table.read().collect()] == [(1, 7.0)]


# -- empty panels and several failures ----------------------------------------------
@pytest.mark.parametrize("rows", ["", "1,1,A,county,CA,5\n", "1,1,A,msa,CA,\n"])
def test_empty_panel_is_skipped(spark, tmp_path, rows):
    raw = land(tmp_path, "metro", {"zori": f"{HEAD},2024-01-31\n{rows}"})
    assert run_family(spark, "rent", raw, str(tmp_path / "t"), grains=["metro"], min_rows=None) == {}


def test_first_file_of_another_grain_empties_the_panel(spark, tmp_path):
    raw = land(tmp_path, "metro", {"inventory_for_sale": f"{HEAD},2024-01-31\n1,1,A,county,CA,5\n",
                                   "new_listings": f"{HEAD},2024-01-31\n1,1,A,msa,CA,7\n"})
    assert run_family(spark, "inventory", raw, str(tmp_path / "t"), grains=["metro"], min_rows=1) == {}


@pytest.mark.parametrize("mode", ["append", "overwrite"])
@pytest.mark.filterwarnings("ignore:overwriting")
def test_empty_write_to_a_partitioned_table_does_nothing(spark, tmp_path, mode):
    t = Table(spark, str(tmp_path / "t"), partition_col="date", partition_fn="substring({}, 1, 4)")
    empty = spark.createDataFrame([], "date string, v int")
    assert t.write(empty, mode) is None and not t.exists()
    t.write(spark.createDataFrame([("2024-01-31", 1)], "date string, v int"))
    assert t.write(empty, mode) is None and t.read().count() == 1


def test_failures_do_not_hide_finished_tables(spark, tmp_path):
    good = f"{HEAD},2024-01-31\n1,1,A,%s,CA,1500\n"
    raw = land(tmp_path, "metro", {"zori": good % "msa"})
    land(tmp_path, "zip", {"zori": f"{HEAD},2024-01-31\n1,1,A,zip,CA,5\n", "new_listings": f"{HEAD},2024-01-31\n1,1,A,zip,CA,-1\n"})
    with pytest.raises(quality.QualityError) as one:
        run_all(spark, raw, str(tmp_path / "t1"), families=["rent"], min_rows=1)
    assert list(one.value.tables) == [("rent", "metro")]
    with pytest.raises(PanelErrors) as two:
        run_all(spark, raw, str(tmp_path / "t2"), families=["rent", "inventory"], min_rows=1)
    assert len(two.value.exceptions) == 2 and list(two.value.tables) == [("rent", "metro")]


# -- incremental --------------------------------------------------------------------
def test_only_new_or_refreshed_files_rebuild_their_table(spark, tmp_path):
    text = f"{HEAD},2024-01-31\n1,1,A,%s,CA,%s\n"
    raw = land(tmp_path, "metro", {"zori": text % ("msa", 1500), "new_listings": text % ("msa", 3)})
    land(tmp_path, "zip", {"zori": text % ("zip", 900)})
    out = str(tmp_path / "t")
    ledger = str(tmp_path / "ledger")
    first = run_all(spark, raw, out, min_rows=1, ledger_root=ledger)
    assert first["ingested"] == 3 and set(first["tables"]) == {("rent", "metro"), ("rent", "zip"), ("inventory", "metro")}
    assert run_all(spark, raw, out, min_rows=1) == {"ingested": 0, "tables": {}, "unknown": []}
    land(tmp_path, "zip", {"zori": text % ("zip", 1000)})
    again = run_all(spark, raw, out, min_rows=1)
    assert again["ingested"] == 1 and set(again["tables"]) == {("rent", "zip")}
    assert [r.rent for r in again["tables"][("rent", "zip")].table.read().collect()] == [1000.0]
    land(tmp_path, "city", {"zori": text % ("city", 5)})  # fails the gate: it stays pending
    for _ in range(2):
        with pytest.raises(quality.QualityError):
            run_all(spark, raw, out, min_rows=1)
    rows = spark.read.json(f"{ledger}/data_outputs").collect()
    assert len(rows) == 3 and all(r.size_bytes > 0 for r in rows)


# -- plans --------------------------------------------------------------------------
def test_join_strategy_follows_the_true_size(spark, write_csv):
    months = ",".join(f"20{y:02d}-01-31" for y in range(10, 25))
    body = lambda n: "".join(f"{i},{i},R{i},zip,CA," + ",".join(["12345.678"] * 15) + "\n" for i in range(n))
    a = read_wide_csv(spark, write_csv("a.csv", f"{HEAD},{months}\n{body(3)}"))
    small = read_wide_csv(spark, write_csv("s.csv", f"{HEAD},{months}\n{body(3)}"))
    large = read_wide_csv(spark, write_csv("l.csv", f"{HEAD},{months}\n{body(3000)}"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
    try:
        under = plan(melt_multi([(a, "x"), (small, "y")]))
        over = plan(melt_multi([(a, "x"), (large, "y")]))
        unknown = plan(melt_multi([(a, "x"), (small.where("RegionID > 0"), "y")]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in under and "SortMergeJoin" not in under
    for p in (over, unknown):
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p


def test_gate_shuffles_keys_only(spark):
    df = spark.range(1000).selectExpr("'2024-01-31' AS date", "id AS region_id", "concat('r', id) AS region_name",
                                      "cast(id AS double) + 100 AS rent")
    spec = quality.family_spec(specs.RENT, df, "zip", min_rows=1)
    p = plan(quality.dq_report(df, spec))
    assert all("SortAggregate(key=[]," in line for line in p.splitlines() if "SortAggregate" in line)  # none by key
    assert "hashpartitioning(__h" in p
    for line in p.splitlines():
        if "hashpartitioning" in line:
            assert "rent" not in line and "region_name" not in line
    assert all(r.passed for r in quality.dq_report(df, spec).collect())


@pytest.mark.parametrize("family", list(specs.FAMILIES))
@pytest.mark.parametrize("grain", specs.GRAINS)
def test_default_floor_is_the_boundary(spark, family, grain):
    fam = specs.FAMILIES[family]
    floor = fam.min_rows.get(grain, fam.default_min_rows)
    value = {c: 1000.0 for c in fam.value_columns}
    value.update({c: (lo if lo is not None else 0.0) + 1 for c, (lo, _hi) in fam.ranges.items()})
    base = "'2024-01-31' AS date, id AS region_id, 'r' AS region_name"
    for n, passes in ((floor, True), (floor - 1, False)):
        df = spark.range(n).selectExpr(*[x.strip() for x in base.split(",")], *[f"{v}D AS {c}" for c, v in value.items()])
        rows = quality.dq_report(df, quality.family_spec(fam, df, grain)).where("rule = 'min_rows'").collect()
        assert [r.passed for r in rows] == [passes]


# -- merge, upsert, tables, ledgers ---------------------------------------------------
def test_packed_merge_equals_the_merge_of_long_frames(spark):
    a = spark.createDataFrame([(1, "A", "1", None), (2, "B", None, "4"), (None, "N", "9", "9")], "RegionID long, RegionName string, `2024-01-31` string, `2024-02-29` string")
    b = spark.createDataFrame([(1, "x", "5", "6"), (3, "C", None, "7"), (None, "n", "8", None)], "RegionID long, RegionName string, `2024-02-29` string, `2024-03-31` string")
    frames = [(a, "u"), (b, "v")]
    want = merge_variants([(melt(df, c), c) for df, c in frames]).where("u IS NOT NULL OR v IS NOT NULL")
    got = merge_variants_packed(frames).select(*want.columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_disjoint_repeats_of_a_region_pass(spark, tmp_path):
    raw = land(tmp_path, "zip", {"inventory_for_sale": f"{HEAD},2024-01-31,2024-02-29\n1,1,A,zip,CA,,\n",
                                 "new_listings": f"{HEAD},2024-01-31,2024-02-29\n1,1,A,zip,CA,3,\n1,1,A,zip,CA,,4\n"})
    res = run_family(spark, "inventory", raw, str(tmp_path / "t"), grains=["zip"], min_rows=1)
    assert sorted((r.date, r.new_listings) for r in res["zip"].table.read().collect()) == [("2024-01-31", 3.0), ("2024-02-29", 4.0)]


def test_upsert_passes_null_keys_by_and_can_split_hot_ones(spark):
    target = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "d", 4)], "k int, v string, own int")
    source = spark.createDataFrame([(1, "A", 1.0), (3, "C", 2.0), (None, "D", 3.0)], "k int, v string, new double")
    got = sorted(map(str, upsert(target, source, ["k"]).collect()))
    want = [(1, "A", 1, 1.0), (1, "A", 2, 1.0), (2, "c", 3, None), (3, "C", None, 2.0), (None, "D", None, 3.0), (None, "d", 4, None)]
    assert got == sorted(str(r) for r in spark.createDataFrame(want, "k int, v string, own int, new double").collect())
    assert "FullOuter" not in plan(upsert(target, source, ["k"], check_duplicates=False))


def test_reads_open_no_footer(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), partition_col="date", partition_fn="substring({}, 1, 4)")
    t.write(spark.createDataFrame([("2023-01-31", 1), ("2024-01-31", 2), ("2024-02-29", 3)], "date string, v int"))
    t.write(spark.createDataFrame([("2025-01-31", 4, "x")], "date string, v int, w string"))
    assert t.columns() == ["date", "v", "w"] and sorted(r.v for r in t.read().collect()) == [1, 2, 3, 4]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("no-footer", "")
    t.read()
    assert not tracker.getJobIdsForGroup("no-footer")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_small_files_appear_whole_or_not_at_all(spark, tmp_path):
    p = str(tmp_path / "x" / "1.json")
    files.write_text(spark, p, "a")
    with pytest.raises(FileExistsError):
        files.write_text(spark, p, "b")
    assert files.read_text(spark, p) == "a" and files.list_names(spark, str(tmp_path / "x")) == ["1.json"]
    files.write_text(spark, p, "c", overwrite=True)
    assert files.read_text(spark, p) == "c" and files.list_names(spark, str(tmp_path / "x")) == ["1.json"]


def test_metadata_faults_come_together(spark):
    with pytest.raises(ValueError, match="'id'.*'title'.*'z'"):
        check_metadata({"column_descriptions": '{"z": "?"}'}, ["a"])


def test_ledger_ties_are_decided(spark):
    rows = [("2024-01-01", "r", "E", m, None, None) for m in ("a", "c", "b")]
    errors = spark.createDataFrame(rows, "timestamp string, run_id string, error_type string, message string, context string, traceback string")
    assert ledgers.error_summary(errors).first().latest_message == "c"


def test_sorted_output_is_in_order(spark):
    df = spark.range(500).select(F.concat(F.lit("2024-0"), (F.col("id") * 7 % 9 + 1).cast("string"), F.lit("-28")).alias("date"),
                                 F.when(F.col("id") % 11 > 0, F.concat(F.lit("r"), (F.col("id") * 13 % 50).cast("string"))).alias("region_name"))
    got = [(r.date, r.region_name is None, r.region_name or "") for r in sort_output(df.repartition(7)).collect()]
    assert got == sorted(got)


def test_workspace_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace(Session())


def test_invalid_text_keeps_its_bytes(spark, tmp_path):
    (tmp_path / "t.txt").write_bytes(b"good\n\xff\xfebad\n")
    rows = scan_text(spark, str(tmp_path / "t.txt")).collect()
    assert [(r.text, bytes(r.bytes), r.valid_utf8) for r in rows] == [("good", b"good", True), (None, b"\xff\xfebad", False)]
    whole = scan_text(spark, str(tmp_path / "t.txt"), whole=True).first()
    assert whole.text is None and bytes(whole.bytes) == b"good\n\xff\xfebad\n"
