"""panelspark: Spark-native statistical panel toolkit.

Wide monthly panel files are melted, merged across metric variants,
standardized, gated by one-pass data-quality rules and written through
append / overwrite / upsert sinks. Every step is a DataFrame transformation;
nothing runs row-at-a-time in Python.

The common entry points are importable from the package root, e.g.
``from panelspark import read_wide_csv, melt_multi, standardize, validate, Table``.
"""

__version__ = "0.1.0"

_EXPORTS = {
    "read_wide_csv": "sources.wide_csv", "scan_raw_text": "sources.raw", "scan_raw_json": "sources.raw",
    "scan_raw_parquet": "sources.raw", "load_table": "sources.raw", "catalog_manifest": "sources.catalog",
    "pending": "sources.catalog", "pending_files": "sources.catalog",
    "melt": "operators.reshape", "melt_multi": "operators.reshape", "merge_variants": "operators.reshape",
    "merge_variants_grid": "operators.reshape", "merge_variants_union": "operators.reshape",
    "standardize": "operators.standardize", "filter_grain": "operators.standardize",
    "sort_output": "operators.standardize",
    "Spec": "operators.quality", "RowCheck": "operators.quality", "YearBounds": "operators.quality",
    "ValueBounds": "operators.quality", "validate": "operators.quality", "dq_report": "operators.quality",
    "family_spec": "operators.quality", "QualityError": "operators.quality",
    "table_changed": "operators.diff", "table_diff": "operators.diff", "state_diff": "operators.diff",
    "stored_changed": "operators.diff", "stored_diff": "operators.diff",
    "run_summary": "operators.ledgers", "error_summary": "operators.ledgers", "request_summary": "operators.ledgers",
    "Table": "sinks.table", "upsert": "sinks.table", "publish": "sinks.publish",
    "save_raw_parquet": "sinks.raw", "save_raw_json": "sinks.raw", "save_raw_text": "sinks.raw",
    "ingest_incremental": "streaming.ingest",
    "build_panel": "plans.panels", "run_panel": "plans.panels", "run_family": "plans.panels",
    "run_all": "plans.panels",
}


def __getattr__(name):  # lazy: importing the package does not import pyspark
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(f".{_EXPORTS[name]}", __name__), name)
    raise AttributeError(name)


__all__ = sorted(_EXPORTS)
