import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
# cheap queries that need no landing: checked against their oracle at sf0.001
QUICK = ["state_diff", "unique_check", "dq_report", "validate", "run_summary", "error_summary",
         "request_summary", "fn_is_week", "fn_in_range", "violations_sample", "upsert_join", "table_diff",
         "pending_anti_join", "null_counts", "min_max_range", "year_bounds", "to_numeric_coerce"]


def test_every_oracle_has_a_query():
    from panelspark.registry import ORACLES, QUERIES
    qs, ors = entry.queries(), entry.oracle_sql()
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(qs) and set(ors) <= set(qs)


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return float(f"{v:.9g}") if not math.isnan(v) else "nan"
        return v.isoformat() if hasattr(v, "isoformat") else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(res.fetchall(), ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["region_id", "region_name", "state_code", "date"] and "grain" in df.columns
    assert dict(df.dtypes)["region_id"] == "bigint" and dict(df.dtypes)["all_homes"] == "double"
    assert df.count() > 0
