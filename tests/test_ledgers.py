from datetime import datetime

from pyspark.sql import functions as F

from panelspark.operators import ledgers as L

T = lambda s: datetime.fromisoformat(s)


def test_run_summary_pairs_start_and_end(spark):
    runs = spark.createDataFrame([
        (T("2024-01-01 00:00:00"), "r1", "start", None, "cloud", "schedule", ""),
        (T("2024-01-01 00:00:30"), "r1", "end", "completed", "cloud", "schedule", ""),
        (T("2024-01-01 00:00:00"), "r2", "start", None, "cloud", "schedule", ""),
        (T("2024-01-01 00:01:00"), "r2", "end", "oom", "cloud", "schedule", ""),
        (T("2024-01-01 00:00:00"), "r3", "start", None, "local", "manual", ""),  # still running
    ], "timestamp timestamp, run_id string, event string, status string, environment string, "
       "trigger string, error string")
    got = {(r.environment, r.status): (r.runs, r.max_duration_s) for r in L.run_summary(runs).collect()}
    assert got == {("cloud", "completed"): (1, 30.0), ("cloud", "oom"): (1, 60.0), ("local", "running"): (1, None)}


def test_exit_status_mapping(spark):
    df = spark.createDataFrame([(0,), (137,), (143,), (1,)], "code int")
    assert [r[0] for r in df.select(L.exit_status("code")).collect()] == ["completed", "oom", "timeout", "failed"]


def test_error_summary_latest_message(spark):
    errs = spark.createDataFrame([
        (T("2024-01-01 00:00:00"), "r1", "KeyError", "a", "", ""),
        (T("2024-01-02 00:00:00"), "r2", "KeyError", "b", "", ""),
        (T("2024-01-01 00:00:00"), "r1", "ValueError", "c", "", ""),
    ], "timestamp timestamp, run_id string, error_type string, message string, context string, traceback string")
    got = {r.error_type: (r.errors, r.latest_message, r.runs) for r in L.error_summary(errs).collect()}
    assert got == {"KeyError": (2, "b", 2), "ValueError": (1, "c", 1)}


def test_request_summary_with_quantiles(spark):
    reqs = spark.createDataFrame([(200, float(i), "") for i in range(1, 101)] + [(500, 5.0, "boom")],
                                 "status int, duration_ms double, error string")
    rows = {r.status: r for r in L.request_summary(reqs, quantiles=True).collect()}
    assert rows[200].requests == 100 and rows[200].failed == 0 and rows[500].failed == 1
    assert rows[200].total_ms == 5050.0 and rows[200].p50_p95_ms == [50.0, 95.0]
