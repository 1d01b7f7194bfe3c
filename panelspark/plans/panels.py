"""The generic panel pipeline: one spec-driven plan for every family and grain.

scan -> (join-before-melt | melt) -> standardize -> stage write -> quality
gate on the written files -> commit (upsert on date, region_id) -> publish
metadata -> output profile.
"""

from __future__ import annotations

import threading
import warnings
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import specs
from ..operators import quality
from ..functions.scalars import to_double
from ..operators.reshape import (date_columns, id_columns, melt, melt_multi, merge_variants_packed, merge_variants_union,
                                 normalize_header_date, of_grain)
from ..operators.standardize import standardize
from ..session import shuffles_dropped
from ..sinks.publish import check_metadata, log_error, log_output
from ..sinks.table import Table
from ..sources import files
from ..sources.catalog import MANIFEST_SCHEMA, pending_files
from ..sources.raw import LANDED_SUFFIXES, landed_metrics, landing_path
from ..sources.wide_csv import read_wide_csv


@dataclass
class PanelResult:
    dataset: str
    table: Table
    rows: int
    report: list


class PanelErrors(ExceptionGroup):
    """Failures of several panels; ``tables`` holds the results of the others."""

    def __new__(cls, message, errors, tables):
        self = super().__new__(cls, message, errors)
        self.tables = tables
        return self

    def derive(self, excs):
        return PanelErrors(self.message, excs, self.tables)


def check_variant_keys(frames: list[tuple[DataFrame, str]], grain_filter: str | None, grid: bool = True) -> None:
    """Fail before the merge when it would publish a (date, region) twice.

    A region that files repeat c_1, c_2, ... times meets itself in all
    combinations; at a month where z_1, z_2, ... of these rows are null,
    prod(c) - prod(z) combinations survive the drop of all-null rows, and two
    are a duplicate for the gate. Only repeated regions are looked at: one
    job over the region keys of all files finds them, and as a rule ends the
    check. Repeats that the merge drops, or that leave one row per month,
    pass, as they pass the gate.
    """
    if len(frames) < 2:
        return
    kept = []
    for i, (df, _col) in enumerate(frames):
        if grid and i == 0 and grain_filter is not None and "RegionType" in df.columns:
            df = df.where(F.lower(F.col("RegionType")) == F.lit(grain_filter))
        kept.append(df)
    n = range(len(kept))
    keys = reduce(DataFrame.unionAll, [df.select(F.lit(i).alias("__i"), F.col("RegionID")) for i, df in enumerate(kept)])
    counts = keys.groupBy("RegionID").agg(*[F.count_if(F.col("__i") == i).alias(f"c{i}") for i in n])
    repeated = counts.where(F.greatest(*[F.col(f"c{i}") for i in n]) > 1)
    if grid:
        repeated = repeated.where(F.col("c0") > 0)
    repeated = repeated.withColumnRenamed("RegionID", "__r")
    if repeated.isEmpty():
        return
    cells = []
    for i, df in enumerate(kept):
        long = melt(df, "__v", ids=id_columns(df)).where(to_double("__v").isNotNull())
        cells.append(long.select(F.lit(i).alias("__i"), "RegionID", "date"))
    filled = reduce(DataFrame.unionAll, cells).groupBy("RegionID", "date").agg(
        *[F.count_if(F.col("__i") == i).alias(f"n{i}") for i in n])
    if grid:
        filled = filled.where(F.col("date").isin([normalize_header_date(m) for m in date_columns(kept[0])]))
    at = filled.join(repeated, F.col("RegionID").eqNullSafe(F.col("__r")))
    rows = [F.greatest(F.col(f"c{i}"), F.lit(1)).cast("double") for i in n]
    product = lambda xs: reduce(lambda a, b: a * b, xs)
    survive = product(rows) - product([c - F.col(f"n{i}") for i, c in zip(n, rows)])
    bad = at.where(survive > 1).select("RegionID", "date", survive.alias("rows")).limit(1).collect()
    if bad:
        raise quality.QualityError([{"rule": "unique", "column": "RegionID", "violations": int(bad[0]["rows"]) - 1,
                                     "detail": f"region {bad[0]['RegionID']} would come more than once at {bad[0]['date']}"}], {})


def build_panel(frames: list[tuple[DataFrame | None, str]], family: specs.Family, grain: str,
                grid: str = "first", check_empty: bool = True, check_keys: bool = True) -> DataFrame | None:
    """Merged, standardized long panel (unsorted), or None when no variant has data.

    ``frames`` is ``[(wide_df or None, value_col), ...]`` in variant order; a
    missing or empty variant is skipped, the first remaining one defines the
    grid and the region attributes.
    """
    present = [(df, col) for df, col in frames if df is not None]
    if check_empty:
        present = [(df, col) for df, col in present if not df.isEmpty()]
    if not present:
        return None
    gfilter = specs.GRAIN_FILTER[grain]
    if check_keys and grid == "first":
        check_variant_keys(present, gfilter, grid="RegionType" in present[0][0].columns)
    elif check_keys:
        check_variant_keys([(of_grain(df, gfilter), col) for df, col in present], None, grid=False)
    first = present[0][0]
    if len(present) == 1:
        long = melt(first, present[0][1])
    elif grid == "union":
        long = merge_variants_union(present, gfilter)
    elif "RegionType" in first.columns:
        long = melt_multi(present, grain_filter=gfilter)
    else:
        # No RegionType: nothing filters the outer rows, so the literal
        # full outer join on (region, month) is the semantics to keep.
        long = merge_variants_packed(present)
    return standardize(long, grain, family.value_columns)


def run_panel(spark: SparkSession, family: specs.Family, grain: str, frames, root: str, *,
              mode: str = "merge", min_rows: int | None = None, grid: str = "first",
              check_empty: bool = True, ledger_root: str | None = None, run_id: str = "local-run") -> PanelResult | None:
    panel = build_panel(frames, family, grain, grid=grid, check_empty=check_empty)
    if panel is None:
        return None
    dataset = family.dataset_id(grain)
    # year partitions: date is part of the merge key, so a refresh rewrites
    # only the years it touches
    table = Table(spark, f"{root.rstrip('/')}/{dataset}", partition_col="date", partition_fn="substring({}, 1, 4)",
                  sort_by=["date", "region_name"])
    staged = table.stage(panel)
    if not staged.rows:
        return None  # nothing after filtering: skipped, like the source
    written = table.read_staged(staged)
    spec = quality.family_spec(family, written, grain, min_rows=min_rows)
    report = quality.validate(written, spec)  # raises before any commit
    meta = check_metadata(family.metadata(grain, written.columns), written.columns)
    # the gate has just proven (date, region_id) unique on these very files
    table.commit(staged, mode, specs.KEY_COLUMNS, metadata=meta, keys_unique=True)
    if ledger_root:  # rows and null cells were observed by the write
        size = sum(sz for _p, sz, _m in files.list_files(spark, staged.path))
        nulls = {c: n for c, n in staged.nulls.items() if n}
        log_output(spark, ledger_root, dataset, staged.rows, size, written.columns, nulls, mode, run_id)
    return PanelResult(dataset, table, staged.rows, report)


def union_grains(results: dict[str, DataFrame]) -> DataFrame:
    frames = [df.withColumn("grain", F.lit(g)) for g, df in results.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fixture_family(spark: SparkSession, sf_dir: str, family: str, root: str, *, grains=None,
                   min_rows: int | None = 1, mode: str = "merge", ledger_root: str | None = None) -> dict:
    """Run one family at every grain on its raw files, landed from ``sf_dir``.

    Production floors (500..500,000 rows) are meant for the real files; the
    fixture tables are small, so the registered queries pass ``min_rows=1``.
    """
    from .fixtures import land_raw

    raw_root = land_raw(spark, sf_dir, grains, specs.FAMILIES[family].value_columns)
    return run_family(spark, family, raw_root, root, grains=grains, min_rows=min_rows, mode=mode,
                      ledger_root=ledger_root)


def load_variants(spark: SparkSession, family: specs.Family, grain: str, raw_root: str):
    """``[(wide_df or None, value_col)]``: a missing file yields None (skipped)."""
    out = []
    for prefix, col in family.variants.items():
        path = landing_path(raw_root, prefix, grain)
        out.append((read_wide_csv(spark, path) if files.exists(spark, path) else None, col))
    return out


#: Landed bytes of a table from which it does not run beside another such table: their shuffles would add up on disk.
LARGE_BYTES = 4 << 20
_LARGE_LOCK = threading.Lock()


def _run_grains(spark: SparkSession, family: str, raw_root: str, root: str, grains, min_rows, mode, ledger_root,
                parallel: int) -> tuple[dict, dict]:
    """(results, errors) of a family by grain: the grain tables are independent, so their pipelines are
    submitted from ``parallel`` driver threads as concurrent jobs of one application, large ones one after the
    other. The shuffles of a job go when it ends."""
    fam = specs.FAMILIES[family]

    def one(grain):
        landed = sum(size for prefix in fam.variants for _p, size, _m in files.list_files(spark, landing_path(raw_root, prefix, grain)))
        with _LARGE_LOCK if landed > LARGE_BYTES else nullcontext():
            frames = load_variants(spark, fam, grain, raw_root)
            return run_panel(spark, fam, grain, frames, root, mode=mode, min_rows=min_rows,
                             check_empty=False, ledger_root=ledger_root)

    with shuffles_dropped(spark), ThreadPoolExecutor(max_workers=max(1, min(parallel, len(grains)))) as pool:
        futures = {g: pool.submit(one, g) for g in grains}
    errors = {g: f.exception() for g, f in futures.items() if f.exception() is not None}
    for grain, e in errors.items():
        e.add_note(f"{family}, {grain}")
    return {g: f.result() for g, f in futures.items() if g not in errors and f.result() is not None}, errors


def run_family(spark: SparkSession, family: str, raw_root: str, root: str, *, grains=None,
               min_rows: int | None = None, mode: str = "merge", ledger_root: str | None = None,
               parallel: int = 5) -> dict:
    """Production entry: one family at every grain from landed wide CSVs.

    A failure (e.g. a quality gate) is raised after the other grains finish:
    the error itself if it is the only one, else all of them; either way it
    has the finished tables as ``tables``. Empty panels are skipped.
    """
    out, errors = _run_grains(spark, family, raw_root, root, list(grains or specs.GRAINS), min_rows, mode, ledger_root, parallel)
    _raise(list(errors.values()), out)
    return out


def _raise(errors: list[Exception], tables: dict) -> None:
    if len(errors) == 1:
        errors[0].tables = tables
        raise errors[0]
    if errors:
        raise PanelErrors("panels failed", errors, tables)


def landed_tables(paths) -> tuple[dict[tuple[str, str], list[str]], list[str]]:
    """(landed files by (family, grain), files that belong to no family)."""
    family_of = {prefix: f.name for f in specs.FAMILIES.values() for prefix in f.variants}
    found, other = landed_metrics(paths, family_of, specs.GRAINS)
    out: dict[tuple[str, str], list[str]] = {}
    for (metric, grain), its in found.items():
        out.setdefault((family_of[metric], grain), []).extend(its)
    return out, other


def rebuild(spark: SparkSession, raw_root: str, tables_root: str, wanted, pending: dict[tuple[str, str], list], *,
            min_rows: int | None = None, mode: str = "merge", ledger_root: str | None = None,
            run_id: str = "local-run") -> tuple[dict, dict]:
    """Build the ``wanted`` (family, grain) tables; (results, errors) by table.

    Families run as concurrent jobs. The ``pending`` files (manifest rows) of
    a table enter the manifest after it has succeeded, so those of a failed
    one are tried again; a failure hides no other table. The error ledger
    gets a row for each failed table, with the names of its pending files.
    """
    todo: dict[str, list[str]] = {}
    for family, grain in wanted:
        todo.setdefault(family, []).append(grain)
    if not todo:
        return {}, {}
    with ThreadPoolExecutor(max_workers=len(todo)) as pool:
        futures = {f: pool.submit(_run_grains, spark, f, raw_root, tables_root, gs, min_rows, mode, ledger_root, 5)
                   for f, gs in todo.items()}
    tables, errors = {}, {}
    for family, future in futures.items():
        done, failed = future.result()
        tables.update({(family, g): r for g, r in done.items()})
        errors.update({(family, g): e for g, e in failed.items()})
    kept = [r for key, rows in pending.items() if key in set(wanted) and key not in errors for r in rows]
    if kept:
        spark.createDataFrame(kept, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(manifest_path(tables_root))
    for (family, grain), e in errors.items() if ledger_root else ():
        names = sorted(r["path"] for r in pending.get((family, grain), []))
        log_error(spark, ledger_root, e, {"family": family, "grain": grain, "files": names}, run_id)
    return tables, errors


def manifest_path(tables_root: str) -> str:
    return f"{tables_root.rstrip('/')}/_manifest"


def read_manifest(spark: SparkSession, tables_root: str) -> DataFrame | None:
    """(path, size, mtime) of the landed files that published tables hold; None before the first."""
    path = manifest_path(tables_root)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path) if files.exists(spark, path) else None


def run_all(spark: SparkSession, raw_root: str, tables_root: str, *, ingest: bool = True, transform: bool = True,
            families=None, grains=None, min_rows: int | None = None, mode: str = "merge",
            ledger_root: str | None = None) -> dict:
    """All families x all grains, with ingest-only / transform-only switches.

    ``raw_root`` holds ``<metric>_<grain>.csv`` files, or folders of part files, plain or gzip. ``ingest``
    compares it with the manifest under ``tables_root``; then ``transform``
    rebuilds only the (family, grain) tables that have a new or refreshed
    file (see :func:`rebuild`). Without ``ingest`` every table is built.
    Failures are raised after all have finished, with the finished tables as
    ``tables``. Regions that a refreshed file no longer has stay in their
    table unless ``mode`` is "overwrite". Returns ``{"ingested": pending files,
    "tables": {(family, grain): PanelResult}, "unknown": landed .csv and
    .csv.gz files of no family}``; the latter never enter the manifest.
    """
    root = tables_root.rstrip("/")
    wanted = [(f, g) for f in families or specs.FAMILIES for g in grains or specs.GRAINS]
    pending: dict[tuple[str, str], list] = {}
    out: dict = {"ingested": 0, "tables": {}, "unknown": []}
    if ingest:
        found = {r["path"]: r for r in pending_files(spark, raw_root, read_manifest(spark, root), suffix=LANDED_SUFFIXES).collect()}  # one per file
        by_table, out["unknown"] = landed_tables(found)
        out["ingested"] = len(found) - len(out["unknown"])
        pending = {k: [found[p] for p in v] for k, v in by_table.items()}
        wanted = [w for w in wanted if w in pending]
        if out["unknown"]:
            warnings.warn(f"no family reads {len(out['unknown'])} landed files, the first is {out['unknown'][0]}", stacklevel=2)
    if transform:
        out["tables"], errors = rebuild(spark, raw_root, root, wanted, pending, min_rows=min_rows, mode=mode, ledger_root=ledger_root)
        _raise(list(errors.values()), out["tables"])
    return out
