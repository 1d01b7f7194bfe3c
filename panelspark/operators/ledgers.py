"""Summaries over the run, error and request ledgers (append-only tables).

Ledger schemas (one row per event):
  runs:      timestamp, run_id, event (start|end), status, environment, trigger, error
  errors:    timestamp, run_id, error_type, message, context, traceback
  requests:  timestamp, run_id, method, url, status, duration_ms, error
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def exit_status(code) -> F.Column:
    c = F.col(code) if isinstance(code, str) else code
    expr = F.when(c == 0, "completed").when(c == 137, "oom").when(c == 143, "timeout")
    return expr.otherwise("failed")


def run_durations(runs: DataFrame) -> DataFrame:
    """One row per run: first start, last end, final status, duration."""
    per_run = runs.groupBy("run_id").agg(
        F.min(F.when(F.col("event") == "start", F.col("timestamp"))).alias("started"),
        F.max(F.when(F.col("event") == "end", F.col("timestamp"))).alias("ended"),
        # ties: the greatest status of the last time, the least of the labels
        F.max(F.when(F.col("event") == "end", F.struct("timestamp", "status")))["status"].alias("status"),
        F.min("environment").alias("environment"),
        F.min("trigger").alias("trigger"),
    )
    # timestampdiff on the stored values: no session time zone (and so no DST
    # shift) is involved, whether the ledger holds TIMESTAMP or TIMESTAMP_NTZ
    return per_run.withColumn(
        "duration_s", F.expr("CAST(timestampdiff(MICROSECOND, started, ended) AS DOUBLE)") / F.lit(1e6))


def run_summary(runs: DataFrame) -> DataFrame:
    """Runs by environment, trigger and status (still running = NULL status)."""
    per_run = run_durations(runs)
    return per_run.groupBy("environment", "trigger", F.coalesce("status", F.lit("running")).alias("status")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.max("duration_s").alias("max_duration_s"),
        F.min("duration_s").alias("min_duration_s"),
    )


def error_summary(errors: DataFrame) -> DataFrame:
    """Count, first/last seen and latest message per error type."""
    return errors.groupBy("error_type").agg(
        F.count(F.lit(1)).alias("errors"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        F.max(F.struct("timestamp", "message"))["message"].alias("latest_message"),  # ties: the greatest
        F.count_distinct("run_id").alias("runs"),
    )


def request_summary(requests: DataFrame, quantiles: bool = False) -> DataFrame:
    """Requests by status: count, failures, total/min/max duration; optional
    approximate p50/p95 (``percentile_approx`` is a mergeable sketch, so a
    hot status does not gather its durations in one place)."""
    aggs = [
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.coalesce(F.col("error"), F.lit("")) != "").alias("failed"),
        # exact, order-independent total (decimal), then mean = total / count
        F.sum(F.col("duration_ms").cast("decimal(18,2)")).cast("double").alias("total_ms"),
        F.min("duration_ms").alias("min_ms"),
        F.max("duration_ms").alias("max_ms"),
    ]
    if quantiles:
        aggs.append(F.percentile_approx("duration_ms", [0.5, 0.95], 10000).alias("p50_p95_ms"))
    out = requests.groupBy("status").agg(*aggs)
    return out.withColumn("avg_ms", F.col("total_ms") / F.col("requests").cast("double"))
