"""Descriptive metadata and the output profile ledger."""

from __future__ import annotations

import json
import traceback
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import files
from .table import Staged, Table


def check_metadata(metadata: dict, columns: list[str]) -> dict:
    """The metadata, if it names the dataset and describes only columns that exist.

    A dataset has an ``id`` and a ``title``; ``column_descriptions`` may be a
    dict or JSON text. All faults are gathered into one error, before
    anything is written."""
    described = metadata.get("column_descriptions") or {}
    if isinstance(described, str):
        described = json.loads(described)
    faults = [f"no {field!r}" for field in ("id", "title") if field not in metadata]
    faults += [f"described column {c!r} is not in the table" for c in sorted(set(described).difference(columns))]
    if faults:
        raise ValueError("metadata cannot be published: " + "; ".join(faults))
    return metadata


def publish(table: Table, metadata: dict) -> None:
    """Attach metadata to a table; its data is not touched."""
    table.set_metadata(check_metadata(metadata, table.columns()))


PROFILE_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("columns", T.StringType()),
    T.StructField("null_counts", T.StringType()),
    T.StructField("mode", T.StringType()),
])

def written_profile(spark: SparkSession, staged: Staged, size_bytes: int) -> DataFrame:
    """The :func:`output_profile` of a write, from what the write itself observed: nothing is read."""
    nulls = {c: n for c, n in staged.nulls.items() if n}
    return spark.createDataFrame([(staged.rows, size_bytes, ",".join(staged.schema.names), nulls)],
                                 "rows long, size_bytes long, columns string, null_counts map<string,long>")


def output_profile(df: DataFrame, size_bytes: int | None = None) -> DataFrame:
    """One row: rows, bytes of the written files, column list, and null counts of columns that have any."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(cols)])
    entries = F.map_from_arrays(
        F.array(*[F.lit(c) for c in cols]),
        F.array(*[F.col(f"__n{i}") for i in range(len(cols))]))
    return agg.select(
        F.col("__rows").cast("long").alias("rows"),
        F.lit(size_bytes).cast("long").alias("size_bytes"),
        F.lit(",".join(cols)).alias("columns"),
        F.map_filter(entries, lambda k, v: v > 0).alias("null_counts"),
    )


def log_output(spark: SparkSession, ledger_root: str, dataset: str, rows: int, size_bytes: int,
               columns: list[str], null_counts: dict, mode: str, run_id: str = "local-run") -> None:
    """Append one row to the ``data_outputs`` ledger table."""
    row = {
        "timestamp": datetime.now(timezone.utc).isoformat(), "run_id": run_id, "dataset": dataset,
        "rows": rows, "size_bytes": size_bytes, "columns": ",".join(columns),
        "null_counts": json.dumps(null_counts) if null_counts else "", "mode": mode,
    }
    _log(spark, ledger_root, "data_outputs", row)


def log_error(spark: SparkSession, ledger_root: str, error: BaseException, context: dict, run_id: str = "local-run") -> None:
    """Append one row to the ``errors`` ledger; ``context`` names what failed (a table and its files)."""
    row = {"timestamp": datetime.now(timezone.utc).isoformat(), "run_id": run_id, "error_type": type(error).__name__,
           "message": str(error), "context": json.dumps(context), "traceback": "".join(traceback.format_exception(error))}
    _log(spark, ledger_root, "errors", row)


def _log(spark: SparkSession, ledger_root: str, ledger: str, row: dict) -> None:
    # One small JSON-lines file per event, created by the driver (no job);
    # the folder reads back as a table with ``spark.read.json``.
    name = f"{row['timestamp'].replace(':', '').replace('-', '')}-{uuid.uuid4().hex[:8]}.json"
    files.write_text(spark, f"{ledger_root.rstrip('/')}/{ledger}/{name}", json.dumps(row) + "\n")
