"""Raw landing-zone sinks (Parquet with metadata, JSON optionally gzip, text/CSV)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame

from ..sources.raw import JSON_TIME_OPTIONS, raw_path


def save_raw_parquet(df: DataFrame, root: str, asset_id: str, metadata: dict | None = None) -> str:
    """Snappy Parquet; ``metadata`` is kept as JSON in the first field's
    metadata, which survives the Parquet round trip."""
    if metadata:
        first = df.columns[0]
        field = next(f for f in df.schema.fields if f.name == first)
        df = df.withMetadata(first, {**field.metadata, "asset_metadata": json.dumps(metadata)})
    path = raw_path(root, asset_id, "parquet")
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def save_raw_json(df: DataFrame, root: str, asset_id: str, compress: bool = False) -> str:
    """JSON lines (one object per row; a deviation from one pretty document)."""
    ext = "json.gz" if compress else "json"
    path = raw_path(root, asset_id, ext)
    writer = df.write.mode("overwrite").options(**JSON_TIME_OPTIONS)
    if compress:
        writer = writer.option("compression", "gzip")
    writer.json(path)
    return path


def save_raw_text(df: DataFrame, root: str, asset_id: str, ext: str = "txt") -> str:
    """``txt``: one line per row of a single string column. ``csv``: quoted
    CSV with a header, so texts with newlines and quotes round-trip."""
    path = raw_path(root, asset_id, ext)
    if ext == "csv":
        (df.write.mode("overwrite").option("header", "true").option("escape", '"')
         .option("quote", '"').option("multiLine", "true").csv(path))
    else:
        df.write.mode("overwrite").text(path)
    return path
