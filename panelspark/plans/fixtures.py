"""Wide monthly panels derived from the driver's TPC-H-style tables.

Production input is one wide CSV per (metric, grain): a row per region, a
column per month. Here the same shape is *derived by Spark* from the given
tables, so every panel query's work grows with them:

* fact = lineitem JOIN orders (+ the grain's dimension), one row per line;
* month = end of the order month, shifted 240 months so the panel spans
  2015..2021 -- inside every family's 2010..2030 year window;
* each grain maps a dimension onto regions (see ``GRAINS``); the metro file
  also carries a national ``country`` row that the grain filter removes;
* each variant is one aggregate (SQL text, shared with the DuckDB oracle)
  of the region-month cell; a region's cells become an array over the
  months, whose text is the columns of the wide file, and a variant's
  file holds only regions with a non-null cell;
* headers differ (``header_cut``): a family's first variant starts later than
  the others, which end earlier;
* the state files have no RegionType, and county names hold line breaks and
  quotes.

The month header is the contiguous month range of the orders table; its
length follows the calendar, never the row count.
"""

from __future__ import annotations

import re
import threading
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import specs
from ..sources import files
from ..sources.raw import landing_path

SHIFT_MONTHS = 240

# --- fixed fixture definitions: value column -> aggregate SQL -------------------
# The aggregates run in Spark (F.expr) and, verbatim, in the DuckDB oracle.
VARIANT_AGGS = {
    "home_value": {
        "all_homes": "max(price)",
        "single_family": "max(CASE WHEN status = 'F' THEN price END)",
        "condo": "max(CASE WHEN status = 'O' THEN price END)",
        "bed_1": "max(CASE WHEN priority = '1-URGENT' THEN price END)",
        "bed_2": "max(CASE WHEN priority = '2-HIGH' THEN price END)",
        "bed_3": "max(CASE WHEN priority = '3-MEDIUM' THEN price END)",
        "bed_4": "max(CASE WHEN priority = '4-NOT SPECIFIED' THEN price END)",
        "bed_5_plus": "max(CASE WHEN priority = '5-LOW' THEN price END)",
        "bottom_tier": "min(price)",
        "top_tier": "max(CASE WHEN rflag = 'N' THEN price END)",
    },
    "rent": {
        "rent": "min(price)",
    },
    "inventory": {
        "for_sale_inventory": "CAST(sum(CASE WHEN status = 'O' THEN 1 END) AS DOUBLE)",
        "new_listings": "CAST(count(*) AS DOUBLE)",
        "new_pending": "CAST(sum(CASE WHEN status = 'P' THEN 1 END) AS DOUBLE)",
    },
    "sales": {
        "median_list_price": "max(price)",
        "median_sale_price": "min(price)",
        "sales_count": "CAST(count(*) AS DOUBLE)",
        "pct_sold_above_list": "CAST(count_if(rflag = 'R') AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(count(*) AS DOUBLE)",
        "pct_sold_below_list": "CAST(count_if(rflag = 'A') AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(count(*) AS DOUBLE)",
        "days_to_pending": "CAST(max(dtp) AS DOUBLE)",
        "pct_price_cut": "CAST(count_if(discount > 0.05) AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(count(*) AS DOUBLE)",
    },
}


@dataclass(frozen=True)
class GrainDef:
    dimension: str  # which dimension supplies regions
    region_type: str | None  # RegionType literal written into the file; None: no such column
    has_state: bool  # file has a StateName column
    country_row: bool  # file carries a national total row


# --- fixed fixture definitions: grain -> dimension ------------------------------
GRAINS = {
    "state": GrainDef("region", None, True, False),
    "metro": GrainDef("nation", "msa", True, True),
    "county": GrainDef("supplier", "county", True, False),
    "city": GrainDef("part", "city", False, False),
    "zip": GrainDef("customer", "zip", True, False),
}
VARIANT_AGGS_BY_COL = {col: sql for fam in VARIANT_AGGS.values() for col, sql in fam.items()}
FIRST_COLUMNS = {next(iter(aggs)) for aggs in VARIANT_AGGS.values()}
COUNTY_SUFFIX = '\n"Co.", South'
COUNTRY_ID = -1
COUNTRY_NAME = "ALL"


def header_cut(col: str, grain: str) -> tuple[int, int]:
    """Months missing at the start and at the end of a variant's header.

    The state grain's first variant is complete: without a RegionType the
    outer merge keeps months that the first variant lacks, without a name,
    and the gate refuses these."""
    if col in FIRST_COLUMNS:
        return (0, 0) if GRAINS[grain].region_type is None else (2, 0)
    return 0, 3


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _month_number(ts: str) -> F.Column:
    return F.year(ts) * 12 + F.month(ts) - 1 + SHIFT_MONTHS


def base_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem JOIN orders: one row per line with the cell inputs and the
    keys every grain needs (customer, supplier, part); ``nations`` lists the
    nation of each row that the customer has."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_partkey",
        F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("rflag"),
        F.col("l_discount").alias("discount"))
    nations = read(spark, sf_dir, "customer").groupBy("c_custkey").agg(F.collect_list("c_nationkey").alias("nations"))
    orders = read(spark, sf_dir, "orders").where(F.col("o_orderdate").isNotNull()).select(
        "o_orderkey", "o_custkey",
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        _month_number("o_orderdate").alias("month"),
        F.datediff(F.last_day(F.col("o_orderdate")), F.to_date(F.col("o_orderdate"))).alias("dtp"))
    orders = orders.join(nations, F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")
    return li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")


CELL_INPUTS = ("month", "price", "status", "priority", "rflag", "discount", "dtp")


def inputs_of(cols) -> list[str]:
    """The cell inputs that the aggregates of the metrics ``cols`` name, and the month."""
    named = set(re.findall(r"\w+", " ".join(VARIANT_AGGS_BY_COL[col] for col in cols)))
    return [c for c in CELL_INPUTS if c == "month" or c in named]


def fact(spark: SparkSession, sf_dir: str, grain: str, base: DataFrame, deal: int | None = None) -> DataFrame:
    """One row per line item with region attributes and the cell inputs.

    With ``deal`` the lines of a region are in one of so many partitions, so
    that no later grouping by region moves them again."""
    g = GRAINS[grain]
    nation = read(spark, sf_dir, "nation")
    inputs = [c for c in CELL_INPUTS if c in base.columns]

    def of_dimension(dim: DataFrame, line_key: str, key: str) -> DataFrame:
        lines = base.where(F.col(line_key).isNotNull()).select(line_key, *inputs)
        if deal:
            lines, dim = lines.repartition(deal, line_key), dim.repartition(deal, key).hint("merge")
        return lines.join(dim, F.col(line_key) == F.col(key))

    if g.dimension in ("region", "nation"):
        f = base.select(*inputs, F.explode("nations").alias("c_nationkey"))
        f = f.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        f = f.join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        if g.dimension == "region":
            rid, rname, state = F.col("r_regionkey"), F.col("r_name"), F.col("r_name")
        else:
            rid, rname, state = F.col("n_nationkey"), F.col("n_name"), F.col("r_name")
    elif g.dimension == "customer":
        cust = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        f = of_dimension(cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey")), "o_custkey", "c_custkey")
        rid, rname, state = F.col("c_custkey"), F.format_string("%05d", F.col("c_custkey")), F.col("n_name")
    elif g.dimension == "supplier":
        sup = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
        f = of_dimension(sup.join(nation, F.col("s_nationkey") == F.col("n_nationkey")), "l_suppkey", "s_suppkey")
        rid, rname, state = F.col("s_suppkey"), F.concat("s_name", F.lit(COUNTY_SUFFIX)), F.col("n_name")
    else:
        f = of_dimension(read(spark, sf_dir, "part").select("p_partkey", "p_name"), "l_partkey", "p_partkey")
        rid, rname, state = F.col("p_partkey"), F.col("p_name"), None
    cols = [
        rid.cast("bigint").alias("RegionID"),
        rname.cast("string").alias("RegionName"),
    ]
    if g.has_state:
        cols.append(state.cast("string").alias("StateName"))
    f = f.select(*cols, *inputs)
    if g.country_row:
        national = f.withColumns({
            "RegionID": F.lit(COUNTRY_ID).cast("bigint"),
            "RegionName": F.lit(COUNTRY_NAME),
            "StateName": F.lit(None).cast("string"),
            "country": F.lit(True),
        })
        f = f.withColumn("country", F.lit(False)).unionByName(national)
    return f


def month_header(spark: SparkSession, sf_dir: str) -> list[str]:
    """Month-end dates from the first to the last order month (one tiny agg)."""
    row = read(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()
    if row is None or row["lo"] is None:
        return []
    lo, hi = row["lo"], row["hi"]
    y0, m0 = lo.year + SHIFT_MONTHS // 12, lo.month
    y1, m1 = hi.year + SHIFT_MONTHS // 12, hi.month
    count = (y1 - y0) * 12 + (m1 - m0) + 1
    out = []
    y, m = y0, m0
    for _ in range(count):
        ny, nm = (y + 1, 1) if m == 12 else (y, m + 1)
        out.append((date(ny, nm, 1).toordinal() - 1))
        y, m = ny, nm
    return [date.fromordinal(o).strftime("%Y-%m-%d") for o in out]


def header_of(months: list[str], col: str, grain: str) -> list[str]:
    start, end = header_cut(col, grain)
    return months[start:len(months) - end]


#: Cells that a task can hold: a grain of no more is aggregated where its lines are read, a larger one is dealt out by region.
CELLS_IN_TASK = 100_000
#: Bytes of stored lines for each partition that they are dealt out to.
DEALT_BYTES = 16 << 20


def region_cells(spark: SparkSession, sf_dir: str, grain: str, months: list[str], base: DataFrame, base_bytes: int,
                 cols=tuple(VARIANT_AGGS_BY_COL)) -> DataFrame:
    """One row per region: ``head``, its attributes, and for each metric of ``cols`` (named by its
    column) the values of the months of the metric's header, both as the text that the
    metric's CSV line has there; months without lines are empty. ``has_<column>``
    tells whether the metric's header has a filled month.

    The lines of a region meet once, as narrow rows: they are aggregated to
    cells and the cells put in a row within the same partition. Cells become
    text once, before they are put in a row."""
    deal = None
    if read(spark, sf_dir, GRAINS[grain].dimension).count() * len(months) > CELLS_IN_TASK:
        deal = max(spark.sparkContext.defaultParallelism, -(-base_bytes // DEALT_BYTES))
    f = fact(spark, sf_dir, grain, base, deal)
    ids = [c for c in f.columns if c not in CELL_INPUTS]
    first = int(months[0][:4]) * 12 + int(months[0][5:7]) - 1
    cells = f.groupBy(*ids, (F.col("month") - first).alias("at")).agg(
        *[F.expr(VARIANT_AGGS_BY_COL[col]).cast("double").alias(col) for col in cols])
    found = cells.groupBy(*ids).agg(F.sort_array(F.collect_list(F.struct("at", *[F.col(col).cast("string").alias(col) for col in cols]))).alias("c"))
    nothing = f"CAST(NULL AS {found.schema['c'].dataType.elementType.simpleString()})"
    gap, rest = "x.at - coalesce(get(c, k - 1).at, -1) - 1", f"{len(months) - 1} - element_at(c, -1).at"
    every = f"flatten(transform(c, (x, k) -> concat(array_repeat({nothing}, {gap}), array(x))))"
    whole = found.selectExpr(f"{_head(grain)} AS head", f"concat({every}, array_repeat({nothing}, {rest})) AS c")
    texts, has = [], []
    for col in cols:
        start, n = header_cut(col, grain)[0], len(header_of(months, col, grain))
        texts.append(f"array_join({f'c.{col}' if n == len(months) else f'slice(c.{col}, {start + 1}, {n})'}, ',', '') AS {col}")
        has.append(f"{col} <> '{',' * (n - 1)}' AS has_{col}")
    return whole.selectExpr("head", *texts).selectExpr("head", *has, *cols)


def _ids(grain: str) -> dict[str, str]:
    """The columns of a wide file before its months, as SQL over a region's attributes."""
    g = GRAINS[grain]
    ids = {"RegionID": "RegionID", "SizeRank": "IF(country, 0L, RegionID)" if g.country_row else "RegionID", "RegionName": "RegionName"}
    if g.region_type is not None:
        ids["RegionType"] = f"IF(country, 'country', '{g.region_type}')" if g.country_row else f"'{g.region_type}'"
    if g.has_state:
        ids["StateName"] = "StateName"
    return ids


def _head(grain: str) -> str:
    """A region's attributes as Spark's CSV writer writes them."""
    from ..sources.wide_csv import CSV_WRITE_OPTIONS

    options = ", ".join(f"'{k}', '{v}'" for k, v in CSV_WRITE_OPTIONS.items())
    fields = ", ".join(f"'{name}', {sql}" for name, sql in _ids(grain).items())
    return f"to_csv(named_struct({fields}), map({options}))"


def wide_metric(regions: DataFrame, col: str, grain: str, months: list[str], n: int | None = None) -> DataFrame:
    """The text of a metric's wide file: a column per month of its header, only regions with a
    non-null cell; in ``n`` partitions at most, each of which begins with the header."""
    rows = regions.where(f"has_{col}").select("head", col)
    rows = rows if n is None else rows.coalesce(n)
    header = ",".join([*_ids(grain), *header_of(months, col, grain)])
    first = "shiftleft(monotonically_increasing_id(), 31) = 0"  # a partition's rows are numbered in the lower 33 bits
    return rows.selectExpr(f"concat(IF({first}, '{header}\n', ''), head, ',', {col}) AS value")


# Landed raw files, memoised per (workspace, tables folder, grain, metric), and the cell inputs of a stored base.
_LANDED: dict[tuple, str] = {}
_BASES: dict[tuple[str, str], list[str]] = {}
_LAND_LOCK = threading.Lock()
LANDING_VERSION = "v9"
#: Metrics written at a time.
WRITERS = 8
#: Stored bytes of a grain's regions, were they of all metrics, for each file of a metric.
FILE_BYTES = 64 << 20
#: Such bytes from which a grain's files are gzip; smaller ones stay plain.
PACK_BYTES = 1 << 20
#: Grains whose files are plain at any size: they are cut by split, which a gzip file is not.
SPLIT_GRAINS = ("county",)


def land_raw(spark: SparkSession, sf_dir: str, grains=None, cols=None) -> str:
    """Land every (metric, grain) wide file as CSV, once per workspace; only the metrics ``cols`` if these are given.

    Per grain: one row per region holds the metrics' months as text
    (``region_cells``), stored once; each metric's file is written
    from its own text, without a shuffle. Files of large grains are gzip
    (``part-*.csv.gz``), but for ``SPLIT_GRAINS``. Returns that folder.

    Grains land one after the other, and what one needs is gone before the
    next: its shuffles, its stored regions, and after the last the stored lines.
    """
    from ..session import shuffles_dropped, workspace

    with _LAND_LOCK, shuffles_dropped(spark):  # callers in several threads must not land the same grain twice
        return _land(spark, sf_dir, grains or specs.GRAINS, list(cols or VARIANT_AGGS_BY_COL), workspace(spark))


def _land(spark, sf_dir, grains, cols, ws) -> str:
    # one landing zone per application: two that share the folder must not overwrite each other's files
    ws = f"{ws}/{spark.sparkContext.applicationId}"
    tag = sf_dir.rstrip("/").replace("/", "_").replace(":", "_")
    root = f"{ws}/raw-{LANDING_VERSION}-{tag}"
    missing = lambda some: {g: cs for g in some if (cs := [c for c in cols if (ws, sf_dir, g, c) not in _LANDED])}
    todo = missing(grains)
    if not todo:
        return root
    months = month_header(spark, sf_dir)
    # The big join happens once: its result is written (cutting lineage) and
    # every grain's aggregation reads it instead of re-shuffling lineitem.
    base_path = f"{root}/_base"
    inputs = inputs_of({c for cs in todo.values() for c in cs})
    if not set(inputs) <= set(_BASES.get((ws, sf_dir), ())):
        found = base_fact(spark, sf_dir).drop(*[c for c in CELL_INPUTS if c not in inputs])
        found.write.mode("overwrite").option("compression", "zstd").parquet(base_path)
        _BASES[ws, sf_dir] = inputs
    base = spark.read.parquet(base_path)
    size_of = lambda path: sum(size for _p, size, _m in files.list_files(spark, path))
    prefix_of = {col: prefix for fam in specs.FAMILIES.values() for prefix, col in fam.variants.items()}

    def metric(df, n, codec, grain, col):
        path = landing_path(root, prefix_of[col], grain)
        wide_metric(df, col, grain, months, n).write.mode("overwrite").option("compression", codec).text(path)
        for name in files.list_names(spark, path):  # Spark names what it writes as text so
            if name.startswith("part-") and ".txt" in name:
                files.rename(spark, f"{path}/{name}", f"{path}/{name.replace('.txt', '.csv')}")

    from concurrent.futures import ThreadPoolExecutor
    for grain, some in todo.items() if months else ():
        staged = f"{root}/_regions/{grain}"
        region_cells(spark, sf_dir, grain, months, base, size_of(base_path), some).write.mode("overwrite").option("compression", "zstd").parquet(staged)
        df = spark.read.parquet(staged)
        filled = df.selectExpr(*[f"max(has_{col}) AS {col}" for col in some]).first()
        size = size_of(staged) * len(VARIANT_AGGS_BY_COL) // len(some)
        codec = "gzip" if size > PACK_BYTES and grain not in SPLIT_GRAINS else "none"
        with ThreadPoolExecutor(max_workers=WRITERS) as pool:  # metrics are independent: land them as concurrent jobs
            # a metric without a region has no file
            written = [pool.submit(metric, df, max(1, -(-size // FILE_BYTES)), codec, grain, col) for col in some if filled[col]]
        for w in written:
            w.result()
        files.delete(spark, staged)
        _LANDED.update({(ws, sf_dir, grain, col): root for col in some})
    if not months:
        _LANDED.update({(ws, sf_dir, g, col): root for g, some in todo.items() for col in some})
    if not missing(specs.GRAINS):
        files.delete(spark, base_path)
        del _BASES[ws, sf_dir]
    return root
