"""The landed wide files against plain Python, and the plan that makes them."""

import calendar
import csv
import datetime as dt
import glob
import threading
import time

import pytest

from panelspark.plans import fixtures as X
from panelspark.sources import files
from panelspark.specs import FAMILIES, GRAINS

PREFIX = {col: prefix for fam in FAMILIES.values() for prefix, col in fam.variants.items()}


@pytest.fixture
def tables(spark, tmp_path):
    """Repeated customers, keys that are null or in no dimension, orders without a date."""
    d = str(tmp_path / "sf")
    ts = lambda y, m: dt.datetime(y, m, 9)
    made = {
        "region": ([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
        "nation": ([(0, "INDIA", 0), (1, "FRANCE", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, 0), (1, 0), (2, 1), (2, 0), (3, None), (None, 1), (5, 1)], "c_custkey bigint, c_nationkey int"),
        "supplier": ([(1, 'S "1"', 0), (2, "S2", 1)], "s_suppkey bigint, s_name string, s_nationkey int"),
        "part": ([(1, "bolt"), (2, "nut, small"), (2, "nut, small")], "p_partkey bigint, p_name string"),
        "orders": ([(k, c, s, p, t) for k, (c, s, p, t) in enumerate([
            (1, "F", "1-URGENT", ts(1995, 1)), (1, "O", "5-LOW", ts(1995, 6)), (2, "P", "2-HIGH", ts(1995, 3)),
            (3, "F", "5-LOW", ts(1995, 4)), (None, "O", "2-HIGH", ts(1995, 5)), (2, "F", "2-HIGH", None), (9, "O", "5-LOW", ts(1995, 9)),
            (5, "O", "5-LOW", ts(1995, 9))])],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz"),
        "lineitem": ([(k, k % 3 + 1 if k != 4 else None, k % 2 + 1, 10.0 * k + n, "NRA"[n % 3], 0.02 * n) for k in range(8) for n in range(4)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_returnflag string, l_discount double"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d, {name: rows for name, (rows, _s) in made.items()}


def expected(rows, col):
    """Zip rows of a metric: (region, name, state) -> {month: value}."""
    nations = {k: n for k, n, _r in rows["nation"]}
    cells = {}
    for ok, _pk, _sk, price, flag, _d in rows["lineitem"]:
        _k, cust, status, _p, day = rows["orders"][ok]
        if day is None:
            continue
        end = dt.date(day.year + 20, day.month, calendar.monthrange(day.year + 20, day.month)[1])
        for c, n in rows["customer"]:
            if c is not None and c == cust and n in nations:
                cells.setdefault((c, f"{c:05d}", nations[n]), {}).setdefault(str(end), []).append((price, status, flag))
    of = {"all_homes": lambda x: max(p for p, _s, _f in x),
          "condo": lambda x: max((p for p, s, _f in x if s == "O"), default=None),
          "new_listings": lambda x: float(len(x)),
          "new_pending": lambda x: float(sum(s == "P" for _p, s, _f in x)) or None,
          "pct_sold_above_list": lambda x: 100.0 * sum(f == "R" for _p, _s, f in x) / len(x)}[col]
    months = [str(dt.date(2015, m, calendar.monthrange(2015, m)[1])) for m in range(1, 10)]
    months = months[2:] if col == "all_homes" else months[:-3]
    out = {}
    for region, by_month in cells.items():
        values = {m: of(x) for m, x in by_month.items() if m in months and of(x) is not None}
        if values:
            out[region] = values
    return out, months


@pytest.mark.parametrize("few", [0, X.CELLS_IN_TASK])  # dealt out by region; aggregated where the lines are read
def test_landed_zip_files_equal_plain_python(spark, tables, monkeypatch, few):
    d, rows = tables
    monkeypatch.setattr(X, "CELLS_IN_TASK", few)
    X._LANDED.clear()
    root = X.land_raw(spark, d, ["zip"])
    for col in ("all_homes", "condo", "new_listings", "new_pending", "pct_sold_above_list"):
        want, months = expected(rows, col)
        got = {}
        for path in glob.glob(f"{root}/{PREFIX[col]}_zip.csv/part-*"):
            with open(path, newline="") as f:
                header, *lines = csv.reader(f)
            assert header == ["RegionID", "SizeRank", "RegionName", "RegionType", "StateName", *months]
            for rid, rank, name, kind, state, *values in lines:
                assert rid == rank and kind == "zip"
                assert (int(rid), name, state) not in got
                got[int(rid), name, state] = {m: float(v) for m, v in zip(months, values) if v}
        assert got == want, col
    assert not files.exists(spark, f"{root}/{PREFIX['bed_1']}_city.csv")


def test_a_metric_without_a_cell_has_no_file(spark, tables):
    d, _rows = tables
    X._LANDED.clear()
    root = X.land_raw(spark, d, ["state", "zip"])
    assert files.exists(spark, f"{root}/{PREFIX['bed_1']}_zip.csv")
    assert not files.exists(spark, f"{root}/{PREFIX['bed_3']}_zip.csv")  # no order has that priority
    assert not files.exists(spark, f"{root}/{PREFIX['bed_3']}_state.csv")


def test_lines_of_a_large_grain_move_once(spark, tables, monkeypatch, capsys):
    """Two exchanges, of the lines and of the dimension; a metric's file needs none."""
    d, _rows = tables
    monkeypatch.setattr(X, "CELLS_IN_TASK", 0)
    months = X.month_header(spark, d)
    base = X.base_fact(spark, d)
    base.write.parquet(f"{d}/_base")
    regions = X.region_cells(spark, d, "city", months, spark.read.parquet(f"{d}/_base"), 1)
    regions.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 2
    regions.write.parquet(f"{d}/_regions")
    X.wide_metric(spark.read.parquet(f"{d}/_regions"), "rent", "city", months).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_large_grains_land_as_gzip_and_are_read_alike(spark, tables, tmp_path, monkeypatch):
    """Packed and plain files hold the same records; ingest, batch run and manifest see both; split files stay plain."""
    from panelspark.plans.panels import run_all
    from panelspark.sources.wide_csv import read_wide_csv
    from panelspark.streaming.ingest import ingest_incremental

    d, _rows = tables
    found, names = {}, {}
    for packed, limit in ((False, 1 << 20), (True, 0)):
        monkeypatch.setattr(X, "PACK_BYTES", limit)
        X._LANDED.clear()
        root = X.land_raw(spark, d, ["zip", "county", "city"])
        for grain in ("zip", "county"):
            path = f"{root}/{PREFIX['all_homes']}_{grain}.csv"
            names[packed, grain] = [p for p, _s, _m in files.list_files(spark, path)]
            found[packed, grain] = sorted(map(str, read_wide_csv(spark, path).collect()))
    assert all(p.endswith(".csv.gz") for p in names[True, "zip"]) and names[True, "zip"]
    assert not any(p.endswith(".gz") for k in ((False, "zip"), (True, "county")) for p in names[k])
    assert found[True, "zip"] == found[False, "zip"] and found[True, "county"] == found[False, "county"]
    out = str(tmp_path / "out")
    first = ingest_incremental(spark, root, out, f"{out}/_checkpoint", min_rows=1, families=["inventory"], grains=["city"])
    assert not first["errors"], first["errors"]
    assert set(first["tables"]) == {("inventory", "city")} and first["files"] >= 1
    assert run_all(spark, root, out, families=["inventory"], grains=["city"], min_rows=1)["tables"] == {}
    assert run_all(spark, root, str(tmp_path / "new"), families=["inventory"], grains=["city"], min_rows=1)["tables"]


def landed(root):
    out = {}
    for path in glob.glob(f"{root}/*.csv/part-*"):
        with open(path, newline="") as f:
            out.setdefault(path.split("/")[-2], []).extend(csv.reader(f))
    return {name: sorted(rows) for name, rows in out.items()}


def test_landing_keeps_files_only(spark, tables):
    """Stored lines and regions go when nothing needs them any more; the session's setting stays."""
    d, _rows = tables
    X._LANDED.clear()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    root = X.land_raw(spark, d)
    assert landed(root) and spark.conf.get(key, None) == before
    assert not files.exists(spark, f"{root}/_base") and not files.list_files(spark, f"{root}/_regions")


def test_a_family_lands_its_own_files(spark, tables, monkeypatch):
    """Metrics landed by family, with the inputs they name, hold the rows of those landed together."""
    from panelspark.plans import panels

    d, _rows = tables
    X._LANDED.clear()
    whole = landed(X.land_raw(spark, d))
    assert X.inputs_of(["rent"]) == ["month", "price"] and X.inputs_of(["pct_price_cut"]) == ["month", "discount"]
    roots = []
    monkeypatch.setattr(panels, "run_family", lambda spark, family, raw_root, *a, **k: roots.append(raw_root))
    X._LANDED.clear()
    monkeypatch.setattr(X, "LANDING_VERSION", "apart")
    seen = {}
    for name, fam in FAMILIES.items():
        panels.fixture_family(spark, d, name, "unused")
        new = {k: v for k, v in landed(roots[-1]).items() if k not in seen}
        assert new and {k.rsplit("_", 1)[0] for k in new} <= set(fam.variants)
        seen.update(new)
    assert seen == whole


def test_large_tables_run_in_turn_without_old_shuffles(spark, tmp_path, monkeypatch):
    """Tables with large files have no shuffles beside each other's, and those of a job go when it ends."""
    from panelspark.plans import panels
    from panelspark.session import shuffles_dropped

    for prefix in FAMILIES["sales"].variants:
        for grain in GRAINS:
            (tmp_path / f"{prefix}_{grain}.csv").write_text("RegionID,SizeRank,RegionName,RegionType,2020-01-31\n1,1,a,b,5\n")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, lock, active, most, settings = spark.conf.get(key, None), threading.Lock(), [0], [0], []

    def slow(*a, **k):
        with lock:
            active[0] += 1
            most[0] = max(most[0], active[0])
            settings.append(spark.conf.get(key, None))
        time.sleep(0.5)
        with lock:
            active[0] -= 1

    monkeypatch.setattr(panels, "run_panel", slow)
    monkeypatch.setattr(panels, "LARGE_BYTES", 0)
    panels.run_family(spark, "sales", str(tmp_path), "unused")
    assert most == [1] and settings == ["true"] * len(GRAINS) and spark.conf.get(key, None) == before
    with shuffles_dropped(spark):
        panels.run_family(spark, "sales", str(tmp_path), "unused")
        assert spark.conf.get(key, None) == "true"
    assert spark.conf.get(key, None) == before


def test_cells_become_text_once_and_every_part_has_the_header(spark, tables, tmp_path, monkeypatch):
    """Stored regions hold each metric's part of its CSV line; a file begins with the header once, however many files there are."""
    d, rows = tables
    monkeypatch.setattr(X, "CELLS_IN_TASK", 0)
    months = X.month_header(spark, d)
    X.base_fact(spark, d).write.parquet(f"{d}/_base")
    regions = X.region_cells(spark, d, "county", months, spark.read.parquet(f"{d}/_base"), 1, ("rent", "new_listings"))
    regions.repartition(3, "head").write.parquet(f"{d}/_regions")
    stored = spark.read.parquet(f"{d}/_regions")
    types = dict(stored.dtypes)
    assert types["head"] == types["rent"] == types["new_listings"] == "string"
    header = ["RegionID", "SizeRank", "RegionName", "RegionType", "StateName"]
    found = {}
    for n in (1, 3):
        lines = X.wide_metric(stored, "new_listings", "county", months, n)
        assert lines.columns == ["value"]
        parts = ["\n".join(r["value"] for r in part) for part in lines.rdd.glom().collect() if part]
        found[n] = []
        for part in parts:
            first, *records = csv.reader(part.splitlines(keepends=True))
            assert first == header + months[:-3] and header not in [r[:5] for r in records]
            found[n] += records
    assert sorted(found[1]) == sorted(found[3]) and len(found[1]) == 2
    assert {r[2] for r in found[1]} == {n + X.COUNTY_SUFFIX for n in ('S "1"', "S2")}
    counted = sum(float(v) for r in found[1] for v in r[5:] if v)
    in_header = [k for k, _c, _s, _p, day in rows["orders"] if day is not None and day.month <= len(months) - 3]
    assert counted == 4 * len(in_header)


def test_panels_run_without_methods_that_the_jvm_does_not_compile(spark):
    from panelspark.session import shuffles_dropped

    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key, None)
    with shuffles_dropped(spark):
        assert spark.conf.get(key) == "8000"
        with shuffles_dropped(spark):
            pass
        assert spark.conf.get(key) == "8000"
    assert spark.conf.get(key, None) == before
