"""Inputs derived from the driver's tables for the ledger and scalar queries.

Each derivation exists twice -- as a Spark plan and as DuckDB SQL with the
same meaning -- so the oracle can restate the query from the raw tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import read

# --- ledgers from the events table -----------------------------------------------
# fixed mapping of event types onto run-ledger rows
RUN_STATUS = {"purchase": "completed", "error": "failed", "view": "timeout", "click": "oom"}
REQUEST_STATUS = {"error": 500, "view": 200, "click": 200, "purchase": 201, "signup": 204}


def _case(col: str, mapping: dict, default=None) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(col) == k, F.lit(v)) if expr is None else expr.when(F.col(col) == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _case_sql(col: str, mapping: dict, default=None) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN {v!r}" if isinstance(v, str) else f"WHEN {col} = '{k}' THEN {v}"
                     for k, v in mapping.items())
    tail = f" ELSE {default!r}" if default is not None else ""
    return f"CASE {whens}{tail} END"


def runs_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.when(F.col("event_type") == "signup", "start").otherwise("end").alias("event"),
        _case("event_type", RUN_STATUS).alias("status"),
        F.when(F.col("user_id") % 2 == 0, "cloud").otherwise("local").alias("environment"),
        F.when(F.col("user_id") % 3 == 0, "schedule").otherwise("manual").alias("trigger"),
        F.lit("").alias("error"),
    )


RUNS_SQL = (
    "SELECT ts AS timestamp, 'run-' || CAST(user_id AS VARCHAR) AS run_id, "
    "CASE WHEN event_type = 'signup' THEN 'start' ELSE 'end' END AS event, "
    f"{_case_sql('event_type', RUN_STATUS)} AS status, "
    "CASE WHEN user_id % 2 = 0 THEN 'cloud' ELSE 'local' END AS environment, "
    "CASE WHEN user_id % 3 = 0 THEN 'schedule' ELSE 'manual' END AS trigger, '' AS error FROM events"
)


def _k(col: str = "props") -> F.Column:
    return F.get_json_object(F.col(col), "$.k").cast("int")


def errors_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events").where(F.col("event_type") == "error")
    k = _k()
    return ev.select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.when(k < 34, "ValueError").when(k < 67, "KeyError").otherwise("TimeoutError").alias("error_type"),
        F.concat(F.lit("k="), k.cast("string")).alias("message"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("context"),
        F.lit("").alias("traceback"),
    )


ERRORS_SQL = (
    "SELECT ts AS timestamp, 'run-' || CAST(user_id AS VARCHAR) AS run_id, "
    "CASE WHEN k < 34 THEN 'ValueError' WHEN k < 67 THEN 'KeyError' ELSE 'TimeoutError' END AS error_type, "
    "'k=' || CAST(k AS VARCHAR) AS message, 'event ' || CAST(event_id AS VARCHAR) AS context, '' AS traceback "
    "FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type = 'error')"
)


def requests_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET").alias("method"),
        F.concat(F.lit("/api/"), F.col("event_type")).alias("url"),
        _case("event_type", REQUEST_STATUS).cast("int").alias("status"),
        F.col("value").alias("duration_ms"),
        F.when(F.col("event_type") == "error", "server error").otherwise("").alias("error"),
    )


REQUESTS_SQL = (
    "SELECT ts AS timestamp, 'run-' || CAST(user_id AS VARCHAR) AS run_id, "
    "CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method, "
    "'/api/' || event_type AS url, "
    f"CAST({_case_sql('event_type', REQUEST_STATUS)} AS INTEGER) AS status, value AS duration_ms, "
    "CASE WHEN event_type = 'error' THEN 'server error' ELSE '' END AS error FROM events"
)


# --- scalar probes: string and numeric columns of the tables ----------------------
def text_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, v): date-like strings in several formats and other text columns."""
    o = read(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    parts = [
        o.select(F.lit("year").alias("source"), F.date_format(d, "yyyy").alias("v")),
        o.select(F.lit("quarter").alias("source"), F.format_string("%d-Q%d", F.year(d), F.quarter(d)).alias("v")),
        o.select(F.lit("month").alias("source"), F.date_format(d, "yyyy-MM").alias("v")),
        o.select(F.lit("week").alias("source"),
                 F.format_string("%04d-W%02d", F.year(d), F.floor((F.dayofyear(d) - 1) / 7).cast("int") + 1).alias("v")),
        o.select(F.lit("date").alias("source"), F.date_format(d, "yyyy-MM-dd").alias("v")),
        o.select(F.lit("priority").alias("source"), F.col("o_orderpriority").alias("v")),
        read(spark, sf_dir, "customer").select(F.lit("name").alias("source"), F.col("c_name").alias("v")),
        read(spark, sf_dir, "part").select(F.lit("brand").alias("source"), F.col("p_brand").alias("v")),
        read(spark, sf_dir, "pages").select(F.lit("url").alias("source"), F.col("url").alias("v")),
        read(spark, sf_dir, "events").select(F.lit("props").alias("source"), F.col("props").alias("v")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


TEXT_PROBE_SQL = " UNION ALL ".join([
    "SELECT 'year' AS source, strftime(o_orderdate, '%Y') AS v FROM orders",
    "SELECT 'quarter', printf('%d-Q%d', year(o_orderdate), quarter(o_orderdate)) FROM orders",
    "SELECT 'month', strftime(o_orderdate, '%Y-%m') FROM orders",
    "SELECT 'week', printf('%04d-W%02d', year(o_orderdate), (dayofyear(o_orderdate) - 1) // 7 + 1) FROM orders",
    "SELECT 'date', strftime(o_orderdate, '%Y-%m-%d') FROM orders",
    "SELECT 'priority', o_orderpriority FROM orders",
    "SELECT 'name', c_name FROM customer",
    "SELECT 'brand', p_brand FROM part",
    "SELECT 'url', url FROM pages",
    "SELECT 'props', props FROM events",
])


def number_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, x): numeric columns of the tables as doubles."""
    parts = [
        read(spark, sf_dir, "customer").select(F.lit("acctbal").alias("source"), F.col("c_acctbal").alias("x")),
        read(spark, sf_dir, "lineitem").select(F.lit("discount_pct").alias("source"),
                                               (F.col("l_discount") * 100).alias("x")),
        read(spark, sf_dir, "lineitem").select(F.lit("quantity").alias("source"), F.col("l_quantity").alias("x")),
        read(spark, sf_dir, "events").select(F.lit("value").alias("source"), F.col("value").alias("x")),
        read(spark, sf_dir, "part").select(F.lit("retailprice").alias("source"), F.col("p_retailprice").alias("x")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


NUMBER_PROBE_SQL = " UNION ALL ".join([
    "SELECT 'acctbal' AS source, c_acctbal AS x FROM customer",
    "SELECT 'discount_pct', l_discount * 100 FROM lineitem",
    "SELECT 'quantity', l_quantity FROM lineitem",
    "SELECT 'value', value FROM events",
    "SELECT 'retailprice', p_retailprice FROM part",
])
