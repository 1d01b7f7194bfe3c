"""Registered queries (one per operator of the inventory) and their oracle SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import specs
from .functions import scalars as S
from .operators import diff as D
from .operators import ledgers as L
from .operators import quality as Q
from .operators import reshape as R
from .operators import standardize as ST
from .plans import derived as DV
from .plans import oracles as O
from .plans.fixtures import land_raw, read
from .plans.panels import fixture_family, union_grains
from .session import scratch
from .sinks import raw as SR
from .sinks.publish import publish
from .sinks.table import Table, upsert
from .sources import catalog as CAT
from .sources import raw as RAW
from .sources.wide_csv import read_wide_csv
from .streaming.ingest import ingest_incremental

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# pipelines (section 2.10)
def _family_query(family: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch(spark, f"panel_{family}")
        results = fixture_family(spark, sf_dir, family, root, ledger_root=f"{root}/_ledgers")
        return union_grains({g: r.table.read() for g, r in results.items()})
    run.__name__ = f"panel_{family}"
    return run


for _fam in ("home_value", "rent", "inventory", "sales"):
    register(f"panel_{_fam}", O.panel_family_sql(_fam))(_family_query(_fam))


# ---------------------------------------------------------------------------
# shared inputs
FAMILY_OF = {col: fam.name for fam in specs.FAMILIES.values() for col in fam.value_columns}
PREFIX_OF = {col: prefix for fam in specs.FAMILIES.values() for prefix, col in fam.variants.items()}


def _wide(spark, sf_dir, col, grain):
    root = land_raw(spark, sf_dir, [grain])
    return read_wide_csv(spark, RAW.landing_path(root, PREFIX_OF[col], grain))


def _long(spark, sf_dir, col, grain):
    """One landed variant melted to long form, cells coerced to double."""
    return ST.to_numeric_coerce(R.melt(_wide(spark, sf_dir, col, grain), col), [col])


def _frames(spark, sf_dir, family, grain):
    return [(_wide(spark, sf_dir, col, grain), col) for col in specs.FAMILIES[family].value_columns]


# ---------------------------------------------------------------------------
# sources (2.1)
@register("scan_wide_csv", " UNION ALL ".join(
    f"SELECT '{PREFIX_OF[c]}' AS metric, count(DISTINCT RegionID) AS regions, count({c}) AS cells, "
    f"min({c}) AS min_v, max({c}) AS max_v FROM ({O.cells_sql('metro', [c])}) WHERE {c} IS NOT NULL"
    for c in FAMILY_OF))
def q_scan_wide_csv(spark, sf_dir):
    """All 21 metric files of the metro grain: a scan for each of their two headers."""
    root = land_raw(spark, sf_dir, ["metro"])
    wide = read_wide_csv(spark, RAW.landing_path(root, "*", "metro"), source_col="_source")
    long = R.melt(wide, "v").select(
        F.regexp_extract("_source", r"([^/]+)_metro[.]csv", 1).alias("metric"), "RegionID", S.to_double("v").alias("v"))
    return long.groupBy("metric").agg(F.count_distinct("RegionID").alias("regions"), F.count("v").alias("cells"),
                                      F.min("v").alias("min_v"), F.max("v").alias("max_v"))


@register("scan_wide_csv_split", " UNION ALL ".join(
    f"SELECT '{PREFIX_OF[c]}' AS metric, count(DISTINCT RegionID) AS regions, count(DISTINCT RegionName) AS names, count({c}) AS cells, "
    f"min({c}) AS min_v, max({c}) AS max_v FROM ({O.cells_sql('county', [c])}) WHERE {c} IS NOT NULL"
    for c in FAMILY_OF))
def q_scan_wide_csv_split(spark, sf_dir):
    """All county files (names hold line breaks and quotes), cut into records by split."""
    root = land_raw(spark, sf_dir, ["county"])
    wide = read_wide_csv(spark, RAW.landing_path(root, "*", "county"), source_col="_source", splittable=True)
    long = R.melt(wide, "v").select(F.regexp_extract("_source", r"([^/]+)_county[.]csv", 1).alias("metric"), "RegionID",
                                    "RegionName", S.to_double("v").alias("v"))
    return long.groupBy("metric").agg(
        F.count_distinct("RegionID").alias("regions"), F.count_distinct("RegionName").alias("names"), F.count("v").alias("cells"),
        F.min("v").alias("min_v"), F.max("v").alias("max_v"))


@register("scan_raw_text", " UNION ALL ".join(
    f"SELECT '{PREFIX_OF[c]}' AS metric, count(DISTINCT RegionID) AS lines, count(DISTINCT RegionID) AS valid_utf8 "
    f"FROM ({O.cells_sql('zip', [c])}) WHERE {c} IS NOT NULL"
    for c in FAMILY_OF))
def q_scan_raw_text(spark, sf_dir):
    root = land_raw(spark, sf_dir, ["zip"])
    lines = RAW.scan_text(spark, RAW.landing_path(root, "*", "zip"))
    data = lines.where(~F.col("text").startswith("RegionID,"))
    return (data.withColumn("metric", F.regexp_extract("path", r"([^/]+)_zip[.]csv", 1))
            .groupBy("metric").agg(F.count(F.lit(1)).alias("lines"),
                                   F.count_if("valid_utf8").alias("valid_utf8")))


@register("scan_raw_bytes", "SELECT lang, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes, true AS all_valid, count(*) AS line_ends "
          "FROM (SELECT lang, replace(text, chr(10), ' ') AS text FROM documents) GROUP BY lang")
def q_scan_raw_bytes(spark, sf_dir):
    """Whole text files as bytes, with their text where they are valid UTF-8."""
    root = f"{scratch(spark, 'raw_bytes')}/docs"
    docs = read(spark, sf_dir, "documents").select("lang", F.translate("text", "\n", " ").alias("text"))
    docs.write.partitionBy("lang").text(root)
    found = RAW.scan_text(spark, root, whole=True)
    return found.groupBy(F.regexp_extract("path", "lang=([^/]+)", 1).alias("lang")).agg(
        F.sum(F.octet_length("bytes")).alias("bytes"), F.every(F.col("valid_utf8")).alias("all_valid"),
        F.sum(F.regexp_count("text", F.lit("\n"))).cast("long").alias("line_ends"))


EVENTS_COLS = "event_id, ts, user_id, event_type, value, props"


@register("scan_raw_json", f"SELECT {EVENTS_COLS}, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def q_scan_raw_json(spark, sf_dir):
    root = scratch(spark, "raw_json")
    ev = read(spark, sf_dir, "events")
    SR.save_raw_json(ev, root, "events", compress=True)  # only the .json.gz exists
    back = RAW.scan_raw_json(spark, root, "events", schema=ev.schema)
    return back.select(*[c.strip() for c in EVENTS_COLS.split(",")],
                       F.get_json_object("props", "$.k").cast("int").alias("k"))


@register("scan_raw_variant", "SELECT event_id, event_type AS kind, "
          "CASE WHEN event_id % 3 = 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k, "
          "CASE event_id % 3 WHEN 1 THEN '\"' || event_type || '\"' WHEN 2 THEN '[' || CAST(event_id AS VARCHAR) || ',{\"x\":true}]' END AS k_other, "
          "CASE WHEN event_id % 3 = 0 THEN user_id END AS late FROM events")
def q_scan_raw_variant(spark, sf_dir):
    """JSON whose field k is a number, a text or a list from record to record, and whose field late is not always there."""
    root = scratch(spark, "raw_variant")
    k = (F.when(F.col("event_id") % 3 == 0, F.get_json_object("props", "$.k"))
         .when(F.col("event_id") % 3 == 1, F.concat(F.lit('"'), "event_type", F.lit('"')))
         .otherwise(F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit(',{"x":true}]'))))
    late = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(',"late":'), F.col("user_id").cast("string"))).otherwise(F.lit(""))
    lines = read(spark, sf_dir, "events").select(F.concat(
        F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"kind":"'), "event_type", F.lit('","deep":{"k":'), k, F.lit("}"), late, F.lit("}")))
    lines.write.text(RAW.raw_path(root, "events", "json"))
    found = RAW.typed_fields(RAW.scan_raw_variant(spark, root, "events"), {
        "event_id": ("$.id", "bigint"), "kind": ("$.kind", "string"), "k": ("$.deep.k", "int"), "late": ("$.late", "bigint")})
    return found.select("event_id", "kind", "k", "k_other", "late")


@register("scan_raw_parquet", f"SELECT {EVENTS_COLS} FROM events")
def q_scan_raw_parquet(spark, sf_dir):
    root = scratch(spark, "raw_parquet")
    SR.save_raw_parquet(read(spark, sf_dir, "events"), root, "events")
    return RAW.scan_raw_parquet(spark, root, "events")


@register("load_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def q_load_table(spark, sf_dir):
    root = scratch(spark, "tables")
    Table(spark, f"{root}/orders").write(read(spark, sf_dir, "orders"), "overwrite")
    return RAW.load_table(spark, root, "orders")


@register("catalog_manifest", " UNION ALL ".join(
    f"SELECT '{c.dataset_id}_{g}' AS key, '{c.dataset_id}' AS dataset_id, '{g}' AS grain, "
    f"'{c.folder}/{c.pattern.replace('{region}', r)}' AS path, '{c.dataset_id}_{g}.csv' AS landing, "
    f"(SELECT count(DISTINCT RegionID) FROM ({O.cells_sql(g, [FAMILY_COL])}) WHERE {FAMILY_COL} IS NOT NULL) AS regions"
    for c in specs.CATALOG
    for FAMILY_COL in [dict((p, col) for fam in specs.FAMILIES.values() for p, col in fam.variants.items())[c.dataset_id]]
    for g, r in zip(specs.GRAINS, ["Metro", "State", "County", "City", "Zip"])))
def q_catalog_manifest(spark, sf_dir):
    root = land_raw(spark, sf_dir)
    lines = spark.read.text(RAW.landing_path(root, "*", "*")).where(F.col("value").rlike("^-?[0-9]+,"))  # names hold line breaks
    counts = lines.groupBy(F.concat(F.regexp_extract("_metadata.file_path", r"([^/]+[.]csv)/", 1)).alias("landing")).agg(
        F.count(F.lit(1)).alias("regions"))
    cat = CAT.catalog_manifest(spark)
    return cat.join(counts, "landing", "left").select(
        "key", "dataset_id", "grain", "path", "landing", F.coalesce("regions", F.lit(0)).cast("long").alias("regions"))


# ---------------------------------------------------------------------------
# sinks (2.2)
ORD_A = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'"
ORD_B = ("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders "
         "WHERE o_orderdate >= TIMESTAMP '1998-01-01'")


def _orders_split(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    a = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_totalprice")
    b = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return a, b


@register("sink_append", f"({ORD_A}) UNION ALL BY NAME ({ORD_B})")
def q_sink_append(spark, sf_dir):
    a, b = _orders_split(spark, sf_dir)
    t = Table(spark, scratch(spark, "append"))
    t.write(a, "append")
    t.write(b, "append")  # new column o_orderstatus: schema evolves
    t.write(b.limit(0), "append")  # zero rows: no-op
    return t.read()


@register("sink_overwrite", ORD_B)
def q_sink_overwrite(spark, sf_dir):
    a, b = _orders_split(spark, sf_dir)
    t = Table(spark, scratch(spark, "overwrite"))
    t.write(a, "append")
    t.write(b, "overwrite")
    return t.read()


MERGE_TARGET = ("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders "
                "WHERE o_orderdate < TIMESTAMP '1999-01-01'")
MERGE_SOURCE = ("SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice, o_orderstatus FROM orders "
                "WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
MERGE_SQL = (
    f"SELECT t.o_orderkey, t.o_custkey, t.o_totalprice, t.o_orderpriority, CAST(NULL AS VARCHAR) AS o_orderstatus "
    f"FROM ({MERGE_TARGET}) t WHERE t.o_orderkey NOT IN (SELECT o_orderkey FROM ({MERGE_SOURCE})) "
    f"UNION ALL SELECT s.o_orderkey, s.o_custkey, s.o_totalprice, t.o_orderpriority, s.o_orderstatus "
    f"FROM ({MERGE_SOURCE}) s LEFT JOIN ({MERGE_TARGET}) t ON s.o_orderkey = t.o_orderkey"
)


def _merge_inputs(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    target = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    source = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderstatus")
    return target, source


@register("sink_merge", MERGE_SQL)
def q_sink_merge(spark, sf_dir):
    target, source = _merge_inputs(spark, sf_dir)
    t = Table(spark, scratch(spark, "merge"))
    t.write(target, "merge", key="o_orderkey")  # missing table: created
    t.write(source, "merge", key="o_orderkey")
    return t.read()


@register("upsert_join", MERGE_SQL)
def q_upsert_join(spark, sf_dir):
    target, source = _merge_inputs(spark, sf_dir)
    return upsert(target, source, ["o_orderkey"])


@register("sink_raw_parquet", f"SELECT {EVENTS_COLS}, 'events' AS asset FROM events")
def q_sink_raw_parquet(spark, sf_dir):
    root = scratch(spark, "raw_parquet")
    SR.save_raw_parquet(read(spark, sf_dir, "events"), root, "events", metadata={"asset": "events"})
    back = RAW.scan_raw_parquet(spark, root, "events")
    meta = RAW.asset_metadata(back) or {}
    return back.withColumn("asset", F.lit(meta.get("asset")))


@register("sink_raw_json", f"SELECT {EVENTS_COLS} FROM events")
def q_sink_raw_json(spark, sf_dir):
    root = scratch(spark, "raw_json")
    ev = read(spark, sf_dir, "events")
    SR.save_raw_json(ev, root, "events")
    return RAW.scan_raw_json(spark, root, "events", schema=ev.schema)


@register("sink_raw_text", "SELECT doc_id, text FROM documents")
def q_sink_raw_text(spark, sf_dir):
    root = scratch(spark, "raw_text")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = SR.save_raw_text(docs, root, "documents", ext="csv")
    back = (spark.read.option("header", "true").option("escape", '"').option("quote", '"')
            .option("multiLine", "true").schema("doc_id bigint, text string").csv(path))
    return back


def _publish_sql() -> str:
    meta = specs.RENT.metadata("metro", ["region_id", "region_name", "state_code", "date", "rent"])
    descs = meta["column_descriptions"]
    count = f"(SELECT count(*) FROM ({O.panel_grain_sql('rent', 'metro', with_grain_col=False)}))"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, '{descs[c]}' AS comment, {count} AS rows"
        for c in ["region_id", "region_name", "state_code", "date", "rent"])


@register("publish_metadata", _publish_sql())
def q_publish_metadata(spark, sf_dir):
    """Column comments of a published panel, read back from the table."""
    root = scratch(spark, "publish")
    results = fixture_family(spark, sf_dir, "rent", root, grains=["metro"])
    table = results["metro"].table
    publish(table, specs.RENT.metadata("metro", table.read().columns))
    df = table.read()
    n = df.count()
    rows = [(f.name, f.metadata.get("comment"), n) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column string, comment string, rows long")


# ---------------------------------------------------------------------------
# reshaping (2.3), filters (2.4), joins (2.5)
HV = specs.HOME_VALUE.value_columns
INV = specs.INVENTORY.value_columns


@register("melt", O.grid_sql("zip", "all_homes", ["all_homes"]))
def q_melt(spark, sf_dir):
    return _long(spark, sf_dir, "all_homes", "zip").select("RegionID", "date", "all_homes")


def _grid(spark, sf_dir, family, grain):
    frames = _frames(spark, sf_dir, family, grain)
    cols = specs.FAMILIES[family].value_columns
    long = R.melt_multi(frames, grain_filter=specs.GRAIN_FILTER[grain])
    return ST.to_numeric_coerce(long, cols), cols


@register("melt_multi", O.grid_sql("zip", "all_homes", HV))
def q_melt_multi(spark, sf_dir):
    long, cols = _grid(spark, sf_dir, "home_value", "zip")
    return long.select("RegionID", "date", *cols)


@register("merge_variants_grid", O.grid_sql("zip", "for_sale_inventory", INV))
def q_merge_variants_grid(spark, sf_dir):
    frames = _frames(spark, sf_dir, "inventory", "zip")
    long = ST.to_numeric_coerce(R.merge_variants_grid(frames, "zip"), INV)
    return long.select("RegionID", "date", *INV)


@register("merge_variants", (
    f"WITH c AS ({O.cells_sql('zip', INV)}), m AS ({O.months_sql()}), "
    "g1 AS (SELECT DISTINCT RegionID, RegionName FROM c WHERE for_sale_inventory IS NOT NULL), "
    # every variant's regions at every month of its own header
    "k AS (" + " UNION ".join(
        f"SELECT r.RegionID, m.date FROM (SELECT DISTINCT RegionID FROM c WHERE {v} IS NOT NULL) r "
        f"CROSS JOIN (SELECT date FROM m WHERE {O.header_sql(v, 'zip')}) m" for v in INV) + ") "
    "SELECT k.RegionID, k.date, g1.RegionName, c.for_sale_inventory, c.new_listings, c.new_pending "
    f"FROM k LEFT JOIN g1 ON g1.RegionID = k.RegionID AND {O.header_sql('for_sale_inventory', 'zip', 'k.date')} "
    "LEFT JOIN c ON c.RegionID = k.RegionID AND c.date = k.date"))
def q_merge_variants(spark, sf_dir):
    longs = [(_long(spark, sf_dir, col, "zip"), col) for col in INV]
    merged = R.merge_variants(longs)
    return merged.select("RegionID", "date", "RegionName", *INV)


_RENT_ATTRS = ("SELECT RegionID AS region_id, RegionID AS SizeRank, RegionName AS region_name, RegionType, "
               "StateName AS state_code, date, rent FROM ({})")


@register("rename_cols", _RENT_ATTRS.format(
    O.grid_sql("zip", "rent", ["rent"], ", r.RegionName, r.RegionType, r.StateName")))
def q_rename_cols(spark, sf_dir):
    return ST.rename_cols(_long(spark, sf_dir, "rent", "zip"))


@register("drop_cols", "SELECT RegionID, RegionName, StateName, date, rent FROM ({})".format(
    O.grid_sql("zip", "rent", ["rent"], ", r.RegionName, r.StateName")))
def q_drop_cols(spark, sf_dir):
    return ST.drop_cols(_long(spark, sf_dir, "rent", "zip"))


@register("state_code_fill", "SELECT RegionID AS region_id, RegionName AS region_name, "
          "COALESCE(StateName, '') AS state_code, date, rent FROM ({})".format(
              O.grid_sql("metro", "rent", ["rent"], ", r.RegionName, r.StateName")))
def q_state_code_fill(spark, sf_dir):
    return ST.state_code_fill(ST.drop_cols(ST.rename_cols(_long(spark, sf_dir, "rent", "metro"))), "metro")


@register("date_normalize", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders")
def q_date_normalize(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("date"))
    return ST.date_normalize(o)


NUMERIC_TEXT_SQL = " UNION ALL ".join([
    "SELECT 'totalprice' AS source, o_orderkey AS key, CAST(o_totalprice AS VARCHAR) AS v FROM orders",
    "SELECT 'priority', o_orderkey, o_orderpriority FROM orders",
    "SELECT 'size', p_partkey, CAST(p_size AS VARCHAR) FROM part",
    "SELECT 'acctbal', c_custkey, CAST(c_acctbal AS VARCHAR) FROM customer",
    "SELECT 'props', event_id, props FROM events",
    "SELECT 'flag', l_orderkey * 10 + l_linenumber, l_returnflag FROM lineitem",
])


def _numeric_text(spark, sf_dir):
    o, p, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "part"), read(spark, sf_dir, "customer")
    parts = [
        o.select(F.lit("totalprice").alias("source"), F.col("o_orderkey").alias("key"),
                 F.col("o_totalprice").cast("string").alias("v")),
        o.select(F.lit("priority"), F.col("o_orderkey"), F.col("o_orderpriority")),
        p.select(F.lit("size"), F.col("p_partkey"), F.col("p_size").cast("string")),
        c.select(F.lit("acctbal"), F.col("c_custkey"), F.col("c_acctbal").cast("string")),
        read(spark, sf_dir, "events").select(F.lit("props"), F.col("event_id"), F.col("props")),
        read(spark, sf_dir, "lineitem").select(F.lit("flag"), F.col("l_orderkey") * 10 + F.col("l_linenumber"),
                                               F.col("l_returnflag")),
    ]
    return reduce(lambda a, b: a.union(b), parts)


@register("to_numeric_coerce",
          "SELECT source, key, CASE WHEN isnan(x) THEN NULL ELSE x END AS v FROM ("
          f"SELECT source, key, CASE WHEN regexp_matches(v, '{S.NUMERIC_TEXT_RE}') "
          f"THEN TRY_CAST(trim(v) AS DOUBLE) END AS x FROM ({NUMERIC_TEXT_SQL}))")
def q_to_numeric_coerce(spark, sf_dir):
    return ST.to_numeric_coerce(_numeric_text(spark, sf_dir), ["v"])


@register("filter_grain", f"SELECT DISTINCT RegionID, RegionName, RegionType FROM ({O.cells_sql('metro', ['all_homes'])}) "
          "WHERE all_homes IS NOT NULL AND lower(RegionType) = 'msa'")
def q_filter_grain(spark, sf_dir):
    return ST.filter_grain(_wide(spark, sf_dir, "all_homes", "metro"), "metro").select(
        "RegionID", "RegionName", "RegionType")


@register("dropna_all", "SELECT * FROM ({}) WHERE {}".format(
    O.grid_sql("zip", "all_homes", HV), " OR ".join(f"{c} IS NOT NULL" for c in HV)))
def q_dropna_all(spark, sf_dir):
    long, cols = _grid(spark, sf_dir, "home_value", "zip")
    return ST.dropna_all(long, cols).select("RegionID", "date", *cols)


@register("sort_output", O.panel_grain_sql("rent", "zip", with_grain_col=False))
def q_sort_output(spark, sf_dir):
    frames = _frames(spark, sf_dir, "rent", "zip")
    from .plans.panels import build_panel
    return ST.sort_output(build_panel(frames, specs.RENT, "zip", check_empty=False))


@register("sort_output_proof", "SELECT count(*) AS rows, true AS in_order, CAST(0 AS BIGINT) AS unordered_files, CAST(0 AS BIGINT) AS overlaps "
          f"FROM ({O.panel_grain_sql('rent', 'zip', with_grain_col=False)})")
def q_sort_output_proof(spark, sf_dir):
    """A panel written in order by one range-partitioned shuffle, and the proof from the bounds of its files."""
    from .plans.panels import build_panel
    path = f"{scratch(spark, 'sorted')}/rent"
    ST.write_sorted(build_panel(_frames(spark, sf_dir, "rent", "zip"), specs.RENT, "zip", check_empty=False), path, ["date", "region_name"])
    proof = ST.sorted_proof(spark, path, ["date", "region_name"])
    return proof.select("rows", ((F.col("unordered_files") == 0) & (F.col("overlaps") == 0)).alias("in_order"), "unordered_files", "overlaps")


@register("pending_anti_join", "SELECT doc_id, source FROM documents d "
          "WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def q_pending_anti_join(spark, sf_dir):
    return CAT.pending(read(spark, sf_dir, "documents").select("doc_id", "source"),
                       read(spark, sf_dir, "labels"), "doc_id")


STATE_SQL = ("SELECT CAST(user_id AS VARCHAR) AS key, CAST(count(*) AS VARCHAR) AS v FROM events {} GROUP BY user_id")


STATE_OLD = STATE_SQL.format("WHERE ts < TIMESTAMP '2024-01-15'")


@register("state_diff", (
    "SELECT COALESCE(o.key, n.key) AS key, COALESCE(o.v, '') AS old_value, COALESCE(n.v, '') AS new_value "
    f"FROM ({STATE_OLD}) o "
    f"FULL OUTER JOIN ({STATE_SQL.format('')}) n ON o.key = n.key WHERE o.v IS DISTINCT FROM n.v"))
def q_state_diff(spark, sf_dir):
    ev = read(spark, sf_dir, "events")

    def state(df):
        return df.groupBy(F.col("user_id").cast("string").alias("key")).agg(
            F.count(F.lit(1)).cast("string").alias("value"))
    old = state(ev.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
    return D.state_diff(old, state(ev))


# ---------------------------------------------------------------------------
# aggregations (2.6)
ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@register("row_count", " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, count(*) AS rows, count(*) >= 1 AS passed FROM {t}" for t in ALL_TABLES))
def q_row_count(spark, sf_dir):
    parts = [read(spark, sf_dir, t).agg(F.lit(t).alias("dataset"), F.count(F.lit(1)).alias("rows"))
             for t in ALL_TABLES]
    return reduce(lambda a, b: a.union(b), parts).withColumn("passed", F.col("rows") >= 1)


DOC_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]
DOC_JOIN_SQL = ("SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic, d.text "
                "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")


def _doc_join(spark, sf_dir):
    return read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left").select(
        *DOC_COLS, "text")


@register("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column, nulls FROM (SELECT count_if({c} IS NULL) AS nulls FROM ({DOC_JOIN_SQL})) "
    "WHERE nulls > 0" for c in DOC_COLS + ["text"]))
def q_null_counts(spark, sf_dir):
    df = _doc_join(spark, sf_dir)
    wide = Q.null_counts(df)
    return wide.unpivot([], df.columns, "column", "nulls").where(F.col("nulls") > 0)


NN_COLS = ["doc_id", "quality", "toxic", "text"]


@register("not_null_check", " UNION ALL ".join(
    f"SELECT 'not_null' AS rule, '{c}' AS column, count_if({c} IS NULL) AS violations, "
    f"count_if({c} IS NULL) = 0 AS passed FROM ({DOC_JOIN_SQL})" for c in NN_COLS))
def q_not_null_check(spark, sf_dir):
    rep = Q.dq_report(_doc_join(spark, sf_dir), Q.Spec(not_null=NN_COLS))
    return rep.where(F.col("rule") == "not_null").select("rule", "column", "violations", "passed")


UNIQUE_CASES = [("lineitem", ["l_orderkey", "l_linenumber"]), ("orders", ["o_orderkey"]),
                ("conversations", ["conv_id", "turn"])]


@register("unique_check", " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, n AS rows, k AS distinct_keys, n - k AS duplicates, n = k AS passed FROM "
    f"(SELECT (SELECT count(*) FROM {t}) AS n, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {t})) AS k)"
    for t, keys in UNIQUE_CASES))
def q_unique_check(spark, sf_dir):
    parts = [Q.unique_violations(read(spark, sf_dir, t), keys).select(
        F.lit(t).alias("dataset"), "rows", "distinct_keys", "duplicates", (F.col("duplicates") == 0).alias("passed"))
        for t, keys in UNIQUE_CASES]
    return reduce(lambda a, b: a.union(b), parts)


BOUNDS = {"l_extendedprice": (0, 100000), "l_discount": (0, 0.1), "l_quantity": (1, 50), "l_tax": (0, 0.05)}


@register("min_max_range", " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(min({c}) AS DOUBLE) AS min_v, CAST(max({c}) AS DOUBLE) AS max_v, "
    f"CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi, "
    f"COALESCE(min({c}) >= {lo} AND max({c}) <= {hi}, TRUE) AS passed FROM lineitem"
    for c, (lo, hi) in BOUNDS.items()))
def q_min_max_range(spark, sf_dir):
    return Q.bounds_report(read(spark, sf_dir, "lineitem"), BOUNDS)


YEAR_CASES = [("orders", "o_orderdate", 1990, 2030), ("lineitem", "l_shipdate", 1996, 2030),
              ("events", "ts", 2010, 2020)]


@register("year_bounds", " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, lo AS min_year, hi AS max_year, COALESCE(lo >= {a} AND hi <= {b}, FALSE) AS passed "
    f"FROM (SELECT CAST(substr(strftime(min({c}), '%Y-%m-%d %H:%M:%S'), 1, 4) AS INTEGER) AS lo, "
    f"CAST(substr(strftime(max({c}), '%Y-%m-%d %H:%M:%S'), 1, 4) AS INTEGER) AS hi FROM {t})"
    for t, c, a, b in YEAR_CASES))
def q_year_bounds(spark, sf_dir):
    parts = [Q.year_bounds_report(read(spark, sf_dir, t), c, a, b).select(F.lit(t).alias("dataset"), "*")
             for t, c, a, b in YEAR_CASES]
    return reduce(lambda a, b: a.union(b), parts)


@register("output_profile", (
    f"SELECT count(*) AS rows, true AS has_bytes, '{','.join(DOC_COLS + ['text'])}' AS columns, "
    "(" + " + ".join(f"CAST(count_if({c} IS NULL) > 0 AS INTEGER)" for c in DOC_COLS + ["text"]) + ") AS null_columns, "
    "(" + " + ".join(f"count_if({c} IS NULL)" for c in DOC_COLS + ["text"]) + ") AS nulls_total "
    f"FROM ({DOC_JOIN_SQL})"))
def q_output_profile(spark, sf_dir):
    """The profile of a table as its write observed it: rows, null counts; and the bytes of its files."""
    from .sinks.publish import written_profile
    from .sources import files
    table = Table(spark, f"{scratch(spark, 'profile')}/docs")
    staged = table.write(_doc_join(spark, sf_dir), "overwrite")
    prof = written_profile(spark, staged, sum(n for _p, n, _m in files.list_files(spark, table.folder())))
    return prof.select("rows", (F.col("size_bytes") > 0).alias("has_bytes"), "columns", F.size("null_counts").alias("null_columns"),
                       F.aggregate(F.map_values("null_counts"), F.lit(0).cast("long"),
                                   lambda acc, x: acc + x).alias("nulls_total"))


@register("violations_sample", (
    "SELECT 'l_extendedprice' AS column, (SELECT count(*) FROM lineitem WHERE l_extendedprice > 100000) AS violations, "
    "CAST(row_number() OVER (ORDER BY v) AS INTEGER) AS rank, v AS value FROM "
    "(SELECT l_extendedprice AS v FROM lineitem WHERE l_extendedprice > 100000 ORDER BY v LIMIT 5)"))
def q_violations_sample(spark, sf_dir):
    chk = Q.range_check("l_extendedprice", 0, 100000)
    return Q.violation_examples(read(spark, sf_dir, "lineitem"), chk, 5)


_SAMPLED = [("in_range", "l_quantity", "l_quantity < 3 OR l_quantity > 45"), ("in_set", "l_returnflag", "l_returnflag NOT IN ('A', 'N')"),
            ("in_range", "l_linenumber", "l_linenumber > 5"), ("in_range", "l_discount", "l_discount < 0.03")]


@register("violations_sample_all", " UNION ALL ".join(
    f"(SELECT {i} AS check, '{rule}' AS rule, '{c}' AS column, CAST(row_number() OVER (ORDER BY {c}) AS INTEGER) AS rank, CAST({c} AS VARCHAR) AS value "
    f"FROM lineitem WHERE {cond} QUALIFY rank <= 5)" for i, (rule, c, cond) in enumerate(_SAMPLED)))
def q_violations_sample_all(spark, sf_dir):
    """Samples of four rules from one scan."""
    checks = [Q.range_check("l_quantity", 3, 45), Q.RowCheck("in_set", "l_returnflag", S.fn_in_set("l_returnflag", ["A", "N"])),
              Q.range_check("l_linenumber", None, 5), Q.range_check("l_discount", 0.03, None)]
    return Q.violations_sample(read(spark, sf_dir, "lineitem"), checks)


# ---------------------------------------------------------------------------
# sort / diff (2.7)
_LI_NEW = "SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'"
_LI_OLD = "SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'"


@register("table_diff", f"(SELECT *, '+' AS change FROM (({_LI_NEW}) EXCEPT ALL ({_LI_OLD}))) UNION ALL "
          f"(SELECT *, '-' AS change FROM (({_LI_OLD}) EXCEPT ALL ({_LI_NEW})))")
def q_table_diff(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    new = li.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    old = li.where(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    return D.table_diff(new, old)


def _by_year(spark, root, column):
    return Table(spark, root, partition_col=column, partition_fn="substring(CAST({} AS STRING), 1, 4)", fingerprints=True)


@register("table_diff_stored", ORACLES["table_diff"])
def q_table_diff_stored(spark, sf_dir):
    """Two stored tables: the year that both hold is told equal by its fingerprints and not scanned."""
    li, root = read(spark, sf_dir, "lineitem"), scratch(spark, "diff")
    new, old = _by_year(spark, f"{root}/new", "l_shipdate"), _by_year(spark, f"{root}/old", "l_shipdate")
    new.write(li.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")))
    old.write(li.where(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    return D.stored_diff(new, old)


_CUST_BUMP = "SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer"
_ORD_CUT = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'"


def _changed_sql(pair, new, old):
    return (f"SELECT '{pair}' AS pair, (SELECT count(*) FROM ({new})) AS rows_new, (SELECT count(*) FROM ({old})) "
            f"AS rows_old, ((SELECT count(*) FROM ({new})) <> (SELECT count(*) FROM ({old})) OR EXISTS "
            f"(({new}) EXCEPT ALL ({old})) OR EXISTS (({old}) EXCEPT ALL ({new}))) AS changed")


@register("table_changed", " UNION ALL ".join([
    _changed_sql("orders_roundtrip", "SELECT * FROM orders", "SELECT * FROM orders"),
    _changed_sql("orders_cut", _ORD_CUT, "SELECT * FROM orders"),
    _changed_sql("customer_bump", _CUST_BUMP, "SELECT * FROM customer"),
]))
def q_table_changed(spark, sf_dir):
    orders, cust = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    t = Table(spark, scratch(spark, "changed"))
    t.write(orders, "overwrite")
    pairs = [
        ("orders_roundtrip", orders, t.read(with_comments=False)),
        ("orders_cut", orders.where(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")), orders),
        ("customer_bump", cust.withColumn("c_acctbal", F.col("c_acctbal") + 1), cust),
    ]
    rows = [(name, new.count(), old.count(), D.table_changed(new, old)) for name, new, old in pairs]
    return spark.createDataFrame(rows, "pair string, rows_new long, rows_old long, changed boolean")


_ORD_BUMP = "SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'"


@register("table_changed_stored", " UNION ALL ".join([
    "SELECT 'in_two_parts' AS pair, (SELECT count(*) FROM orders) AS rows_new, (SELECT count(*) FROM orders) AS rows_old, false AS changed",
    f"SELECT 'merged_same', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders), false",
    f"SELECT 'merged_other', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders), (SELECT count(*) > 0 FROM ({_ORD_BUMP}))",
]))
def q_table_changed_stored(spark, sf_dir):
    """A table written in two parts equals the one written at once; so after merging the same rows, not after merging others."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    root = scratch(spark, "changed")
    whole, parts = _by_year(spark, f"{root}/whole", "o_orderdate"), _by_year(spark, f"{root}/parts", "o_orderdate")
    whole.write(o)
    parts.write(o.where(~late))
    parts.write(o.where(late), "append")
    out = []
    for name, source in (("in_two_parts", None), ("merged_same", o.where(late)),
                         ("merged_other", o.where(late).withColumn("o_totalprice", F.col("o_totalprice") + 1))):
        if source is not None:
            parts.write(source, "merge", key=["o_orderkey", "o_orderdate"])
        out.append((name, parts.read().count(), whole.read().count(), D.stored_changed(parts, whole)))
    return spark.createDataFrame(out, "pair string, rows_new long, rows_old long, changed boolean")


# ---------------------------------------------------------------------------
# scalar functions (2.8): each predicate over the probe columns of the tables
def _text_counts(spark, sf_dir, pred):
    probe = DV.text_probe(spark, sf_dir)
    return probe.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(pred(F.col("v"))).alias("valid"))


def _text_sql(cond: str) -> str:
    return (f"SELECT source, count(*) AS n, count_if(v IS NULL OR COALESCE({cond}, FALSE)) AS valid "
            f"FROM ({DV.TEXT_PROBE_SQL}) GROUP BY source")


def _rx(pattern: str) -> str:
    return f"regexp_matches(CAST(v AS VARCHAR), '{pattern}')"


_ANY_DATE = "|".join(f"(?:{p})" for p in (specs.YEAR_RE, specs.QUARTER_RE, specs.MONTH_RE, specs.WEEK_RE, specs.DATE_RE))
_SET = ["1-URGENT", "2-HIGH", "NATION_1", "ASIA"]
_PATTERN = r"[A-Z][a-z]+#\d"

_TEXT_FNS = {
    "fn_is_year": (S.fn_is_year, _rx(specs.YEAR_RE)),
    "fn_is_quarter": (S.fn_is_quarter, _rx(specs.QUARTER_RE)),
    "fn_is_month": (S.fn_is_month, _rx(specs.MONTH_RE)),
    "fn_is_week": (S.fn_is_week, _rx(specs.WEEK_RE)),
    "fn_is_date": (S.fn_is_date, _rx(specs.DATE_RE)),
    "fn_is_date_any": (S.fn_is_date_any, _rx(_ANY_DATE)),
    "fn_max_length": (lambda c: S.fn_max_length(c, 10), "length(v) <= 10"),
    "fn_min_length": (lambda c: S.fn_min_length(c, 8), "length(v) >= 8"),
    "fn_exact_length": (lambda c: S.fn_exact_length(c, 7), "length(v) = 7"),
    "fn_matches_pattern": (lambda c: S.fn_matches_pattern(c, _PATTERN), _rx(f"^(?:{_PATTERN})")),
    "fn_in_set": (lambda c: S.fn_in_set(c, _SET), "v IN (" + ", ".join(f"'{x}'" for x in _SET) + ")"),
}

for _name, (_fn, _cond) in _TEXT_FNS.items():
    register(_name, _text_sql(_cond))(lambda spark, sf_dir, _fn=_fn: _text_counts(spark, sf_dir, _fn))


def _num_counts(spark, sf_dir, **preds):
    probe = DV.number_probe(spark, sf_dir)
    return probe.groupBy("source").agg(F.count(F.lit(1)).alias("n"),
                                       *[F.count_if(p(F.col("x"))).alias(k) for k, p in preds.items()])


def _num_sql(**conds) -> str:
    cols = ", ".join(f"count_if(x IS NULL OR COALESCE({c}, FALSE)) AS {k}" for k, c in conds.items())
    return f"SELECT source, count(*) AS n, {cols} FROM ({DV.NUMBER_PROBE_SQL}) GROUP BY source"


register("fn_positive", _num_sql(valid="x >= 0", valid_strict="x > 0"))(
    lambda spark, sf_dir: _num_counts(spark, sf_dir, valid=lambda c: S.fn_positive(c),
                                      valid_strict=lambda c: S.fn_positive(c, allow_zero=False)))
register("fn_in_range", _num_sql(valid="x >= 10 AND x <= 1000", valid_lo="x >= 10", valid_hi="x <= 1000"))(
    lambda spark, sf_dir: _num_counts(spark, sf_dir, valid=lambda c: S.fn_in_range(c, 10, 1000),
                                      valid_lo=lambda c: S.fn_in_range(c, lo=10),
                                      valid_hi=lambda c: S.fn_in_range(c, hi=1000)))
register("fn_percentage", _num_sql(valid="x >= 0 AND x <= 100"))(
    lambda spark, sf_dir: _num_counts(spark, sf_dir, valid=S.fn_percentage))


@register("fn_lower", "SELECT c_custkey, lower(c_mktsegment) AS segment, lower(c_name) AS name FROM customer")
def q_fn_lower(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    return c.select("c_custkey", S.fn_lower("c_mktsegment").alias("segment"), S.fn_lower("c_name").alias("name"))


@register("fn_substr_year", "SELECT CAST(substr(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), 1, 4) AS INTEGER) AS year, "
          "count(*) AS n FROM orders GROUP BY 1")
def q_fn_substr_year(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return o.groupBy(S.fn_substr_year(F.col("o_orderdate").cast("string")).alias("year")).agg(
        F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# quality gate (2.9)
def _lineitem_spec():
    return Q.Spec(
        columns={"l_orderkey": "int", "l_extendedprice": "double", "l_shipdate": "timestamp", "l_returnflag": "int"},
        not_null=["l_orderkey", "l_returnflag"],
        unique=["l_orderkey", "l_linenumber"],
        min_rows=1000,
        checks=[Q.range_check("l_discount", 0, 0.08),
                Q.RowCheck("in_set", "l_returnflag", S.fn_in_set("l_returnflag", ["A", "N"]))],
    )


DQ_SQL = " UNION ALL ".join([
    "SELECT 'column_type' AS rule, 'l_orderkey' AS column, 0 AS violations, TRUE AS passed",
    "SELECT 'column_type', 'l_extendedprice', 0, TRUE",
    "SELECT 'column_type', 'l_shipdate', 0, TRUE",
    "SELECT 'column_type', 'l_returnflag', 1, FALSE",
    "SELECT 'min_rows', NULL, GREATEST(1000 - count(*), 0), count(*) >= 1000 FROM lineitem",
    "SELECT 'row_count', NULL, 0, TRUE",
    "SELECT 'not_null', 'l_orderkey', count_if(l_orderkey IS NULL), count_if(l_orderkey IS NULL) = 0 FROM lineitem",
    "SELECT 'not_null', 'l_returnflag', count_if(l_returnflag IS NULL), count_if(l_returnflag IS NULL) = 0 FROM lineitem",
    "SELECT 'unique', 'l_orderkey,l_linenumber', n - k, n = k FROM (SELECT (SELECT count(*) FROM lineitem) AS n, "
    "(SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS k)",
    "SELECT 'in_range', 'l_discount', count_if(l_discount < 0 OR l_discount > 0.08), "
    "count_if(l_discount < 0 OR l_discount > 0.08) = 0 FROM lineitem",
    "SELECT 'in_set', 'l_returnflag', count_if(l_returnflag NOT IN ('A', 'N')), "
    "count_if(l_returnflag NOT IN ('A', 'N')) = 0 FROM lineitem",
])


@register("dq_report", DQ_SQL)
def q_dq_report(spark, sf_dir):
    return Q.dq_report(read(spark, sf_dir, "lineitem"), _lineitem_spec()).select(
        "rule", "column", "violations", "passed")


def _orders_spec():
    return Q.Spec(
        columns={"o_orderkey": "int", "o_totalprice": "double", "o_orderstatus": "string"},
        not_null=["o_orderkey", "o_orderdate"],
        unique="o_orderkey",
        min_rows=100,
        checks=[Q.RowCheck("in_set", "o_orderstatus", S.fn_in_set("o_orderstatus", ["F", "O", "P"])),
                Q.range_check("o_totalprice", 0, 600000),
                Q.YearBounds("o_orderdate", 1990, 2030)],
    )


VALIDATE_SQL = " UNION ALL ".join([
    "SELECT 'column_type' AS rule, 'o_orderkey' AS column, 0 AS violations, TRUE AS passed",
    "SELECT 'column_type', 'o_totalprice', 0, TRUE",
    "SELECT 'column_type', 'o_orderstatus', 0, TRUE",
    "SELECT 'min_rows', NULL, GREATEST(100 - count(*), 0), count(*) >= 100 FROM orders",
    "SELECT 'row_count', NULL, 0, TRUE",
    "SELECT 'not_null', 'o_orderkey', count_if(o_orderkey IS NULL), count_if(o_orderkey IS NULL) = 0 FROM orders",
    "SELECT 'not_null', 'o_orderdate', count_if(o_orderdate IS NULL), count_if(o_orderdate IS NULL) = 0 FROM orders",
    "SELECT 'unique', 'o_orderkey', count(*) - count(DISTINCT o_orderkey), count(*) = count(DISTINCT o_orderkey) FROM orders",
    "SELECT 'in_set', 'o_orderstatus', count_if(o_orderstatus NOT IN ('F', 'O', 'P')), "
    "count_if(o_orderstatus NOT IN ('F', 'O', 'P')) = 0 FROM orders",
    "SELECT 'in_range', 'o_totalprice', count_if(o_totalprice < 0 OR o_totalprice > 600000), "
    "count_if(o_totalprice < 0 OR o_totalprice > 600000) = 0 FROM orders",
    "SELECT 'year_bounds', 'o_orderdate', CASE WHEN year(min(o_orderdate)) >= 1990 AND year(max(o_orderdate)) <= 2030 "
    "THEN 0 ELSE 1 END, year(min(o_orderdate)) >= 1990 AND year(max(o_orderdate)) <= 2030 FROM orders",
])


@register("validate", VALIDATE_SQL)
def q_validate(spark, sf_dir):
    rows = Q.validate(read(spark, sf_dir, "orders"), _orders_spec())  # raises on failure
    return spark.createDataFrame([(r["rule"], r["column"], r["violations"], r["passed"]) for r in rows],
                                 "rule string, column string, violations long, passed boolean")


@register("quality_gate", "SELECT 'orders' AS dataset, TRUE AS passed, count(*) AS rows_written FROM orders "
          "UNION ALL SELECT 'lineitem', FALSE, 0")
def q_quality_gate(spark, sf_dir):
    """Gate before write: a failing dataset is never written."""
    root = scratch(spark, "gated")
    out = []
    for name, spec in (("orders", _orders_spec()), ("lineitem", _lineitem_spec())):
        df = read(spark, sf_dir, name)
        try:
            Q.validate(df, spec)
        except Q.QualityError:
            out.append((name, False, 0))
            continue
        t = Table(spark, f"{root}/{name}")
        t.write(df, "overwrite")
        out.append((name, True, t.read().count()))
    return spark.createDataFrame(out, "dataset string, passed boolean, rows_written long")


# ---------------------------------------------------------------------------
# ledgers (2.11)
@register("run_summary", (
    "SELECT environment, trigger, COALESCE(status, 'running') AS status, count(*) AS runs, "
    "max(duration_s) AS max_duration_s, min(duration_s) AS min_duration_s FROM ("
    "SELECT run_id, min(CASE WHEN event = 'start' THEN timestamp END) AS started, "
    "max(CASE WHEN event = 'end' THEN timestamp END) AS ended, "
    "arg_max(status, timestamp) FILTER (WHERE event = 'end') AS status, "
    "first(environment) AS environment, first(trigger) AS trigger, "
    "CAST(epoch_us(max(CASE WHEN event = 'end' THEN timestamp END)) - epoch_us(min(CASE WHEN event = 'start' "
    "THEN timestamp END)) AS DOUBLE) / 1e6 AS duration_s "
    f"FROM ({DV.RUNS_SQL}) GROUP BY run_id) GROUP BY ALL"))
def q_run_summary(spark, sf_dir):
    return L.run_summary(DV.runs_ledger(spark, sf_dir))


@register("error_summary", (
    "SELECT error_type, count(*) AS errors, min(timestamp) AS first_seen, max(timestamp) AS last_seen, "
    f"arg_max(message, timestamp) AS latest_message, count(DISTINCT run_id) AS runs FROM ({DV.ERRORS_SQL}) "
    "GROUP BY error_type"))
def q_error_summary(spark, sf_dir):
    return L.error_summary(DV.errors_ledger(spark, sf_dir))


@register("request_summary", (
    "SELECT *, total_ms / CAST(requests AS DOUBLE) AS avg_ms FROM ("
    "SELECT status, count(*) AS requests, count_if(COALESCE(error, '') <> '') AS failed, "
    "CAST(sum(CAST(duration_ms AS DECIMAL(18,2))) AS DOUBLE) AS total_ms, min(duration_ms) AS min_ms, "
    f"max(duration_ms) AS max_ms FROM ({DV.REQUESTS_SQL}) GROUP BY status)"))
def q_request_summary(spark, sf_dir):
    return L.request_summary(DV.requests_ledger(spark, sf_dir))


@register("ingest_incremental", " UNION ALL ".join(
    f"SELECT '{specs.FAMILIES[f].dataset_id(g)}' AS dataset, (SELECT count(*) FROM ({O.panel_grain_sql(f, g, with_grain_col=False)})) AS rows, "
    + " + ".join(f"CAST((SELECT count({c}) > 0 FROM ({O.cells_sql(g, [c])})) AS BIGINT)" for c in specs.FAMILIES[f].value_columns)
    + " AS metrics, CAST(0 AS BIGINT) AS second_run_tables, CAST(0 AS BIGINT) AS batch_run_tables"
    for f in specs.FAMILIES for g in specs.GRAINS))
def q_ingest_incremental(spark, sf_dir):
    """The stream rebuilds every table from the landing zone; a second run of it, and a batch run, find nothing to do."""
    from .plans.panels import landed_tables, read_manifest, run_all
    raw, work = land_raw(spark, sf_dir), scratch(spark, "ingest")
    args = (spark, raw, f"{work}/tables", f"{work}/_checkpoint")
    first = ingest_incremental(*args, min_rows=1)
    second = ingest_incremental(*args, min_rows=1)
    batch = run_all(spark, raw, f"{work}/tables", min_rows=1)
    by_table, _ = landed_tables([r["path"] for r in read_manifest(spark, f"{work}/tables").collect()])
    metrics = {k: len({p.rsplit("/", 2)[-2] for p in v}) for k, v in by_table.items()}
    return spark.createDataFrame(
        [(r.dataset, r.rows, metrics[k], len(second["tables"]), len(batch["tables"])) for k, r in first["tables"].items()],
        "dataset string, rows long, metrics long, second_run_tables long, batch_run_tables long")


# ---------------------------------------------------------------------------
# all families x all grains (2.10)
def _columns_of(family: str, grain: str) -> str:
    from .plans.fixtures import GRAINS as FG
    cols = ["region_id", "region_name"]
    if FG[grain].has_state and grain != "state":
        cols.append("state_code")
    return ",".join(cols + ["date"] + specs.FAMILIES[family].value_columns)


@register("panel_all", " UNION ALL ".join(
    f"SELECT '{specs.FAMILIES[f].dataset_id(g)}' AS dataset, count(*) AS rows, '{_columns_of(f, g)}' AS columns, "
    f"true AS has_bytes, {' + '.join(f'count_if({c} IS NULL)' for c in specs.FAMILIES[f].value_columns)} AS null_cells, "
    f"CAST(0 AS BIGINT) AS rebuilt "
    f"FROM ({O.panel_grain_sql(f, g, with_grain_col=False)})"
    for f in specs.FAMILIES for g in specs.GRAINS))
def q_panel_all(spark, sf_dir):
    """Every family at every grain; returns the data_outputs ledger rows, and
    how many tables a second run over the same files rebuilds."""
    from .plans.panels import run_all
    root = scratch(spark, "panel_all")
    ledger = f"{root}/_ledgers"
    raw = land_raw(spark, sf_dir)
    run_all(spark, raw, root, min_rows=1, ledger_root=ledger)
    again = run_all(spark, raw, root, min_rows=1, ledger_root=ledger)
    nulls = F.aggregate(F.map_values(F.from_json("null_counts", "map<string,bigint>")), F.lit(0).cast("long"), lambda a, x: a + x)
    return spark.read.json(f"{ledger}/data_outputs").select(
        "dataset", "rows", "columns", (F.col("size_bytes") > 0).alias("has_bytes"),
        F.coalesce(F.when(F.col("null_counts") != "", nulls), F.lit(0).cast("long")).alias("null_cells"),
        F.lit(len(again["tables"])).cast("long").alias("rebuilt"))
