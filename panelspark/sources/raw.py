"""Raw landing-zone sources: text, JSON (plain or gzip), Parquet, and the
published-table loader. A raw asset is ``<asset_id>.<ext>`` (one file, or a
folder of part files, as Spark writes them) in ``<root>/raw``; the landing
zone of the panels holds ``<metric>_<grain>.csv`` in the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.table import Table
from . import files


# Microsecond timestamps (the JSON default keeps milliseconds only).
JSON_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


#: Names that a landing zone's wide files end with.
LANDED_SUFFIXES = (".csv", ".csv.gz")


def asset_path(folder: str, asset_id: str, ext: str) -> str:
    return f"{folder.rstrip('/')}/{asset_id}.{ext}"


def raw_path(root: str, asset_id: str, ext: str) -> str:
    return asset_path(f"{root.rstrip('/')}/raw", asset_id, ext)


def landing_path(landing: str, metric: str, grain: str) -> str:
    """Where a metric's wide panel of a grain lands; ``*`` stands for any metric or grain."""
    return asset_path(landing, f"{metric}_{grain}", "csv")


def landed_metrics(paths, metrics, grains) -> tuple[dict[tuple[str, str], list[str]], list[str]]:
    """(files by (metric, grain), files that are none of these) of a landing zone's listing."""
    keys = {landing_path("", m, g): (m, g) for m in metrics for g in grains}
    found: dict[tuple[str, str], list[str]] = {}
    other = []
    for path in paths:
        # the file itself, or a part file in a folder of its name
        key = next((keys[n] for n in (f"/{x}" for x in path.split("/")[-2:]) if n in keys), None)
        if key is None:
            other.append(path)
        else:
            found.setdefault(key, []).append(path)
    return found, sorted(other)


def scan_raw_text(spark: SparkSession, root: str, asset_id: str, ext: str = "txt",
                  whole: bool = False) -> DataFrame:
    """A raw text asset; see :func:`scan_text`."""
    path = raw_path(root, asset_id, ext)
    if not files.exists(spark, path):
        raise FileNotFoundError(f"no raw file at {path}")
    return scan_text(spark, path, whole)


def scan_text(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Text lines (or whole files) with a UTF-8 validity flag. Invalid bytes
    are not decoded lossily: ``binaryFile`` keeps the bytes, and ``text`` is
    NULL where the content is not valid UTF-8 (the bytes fallback)."""
    if whole:
        df = (spark.read.format("binaryFile").load(path)
              .select("path", F.col("content").alias("bytes")))
        return df.select("path", "bytes", F.try_validate_utf8(F.col("bytes").cast("string")).alias("text"),
                         F.is_valid_utf8(F.col("bytes").cast("string")).alias("valid_utf8"))
    lines = spark.read.text(path)
    return lines.select(F.try_validate_utf8("value").alias("text"), F.col("value").cast("binary").alias("bytes"),
                        F.col("_metadata.file_path").alias("path"), F.is_valid_utf8("value").alias("valid_utf8"))


def scan_raw_json(spark: SparkSession, root: str, asset_id: str, schema: T.StructType | None = None,
                  multi_line: bool = False) -> DataFrame:
    """JSON asset: ``.json`` first, then ``.json.gz`` (gzip by extension)."""
    for ext in ("json", "json.gz"):
        path = raw_path(root, asset_id, ext)
        if files.exists(spark, path):
            reader = spark.read.option("multiLine", str(multi_line).lower()).options(**JSON_TIME_OPTIONS)
            if schema is not None:
                reader = reader.schema(schema)
            return reader.json(path)
    raise FileNotFoundError(f"no raw JSON file for {asset_id!r} under {root}")


def scan_raw_variant(spark: SparkSession, root: str, asset_id: str, multi_line: bool = False) -> DataFrame:
    """JSON asset without a schema: one VARIANT column ``value``, a row for each record.

    Nothing is inferred, so a field that changes its type, comes late or is
    nested differently from record to record loses nothing.
    """
    for ext in ("json", "json.gz"):
        path = raw_path(root, asset_id, ext)
        if files.exists(spark, path):
            return spark.read.option("singleVariantColumn", "value").option("multiLine", str(multi_line).lower()).json(path)
    raise FileNotFoundError(f"no raw JSON file for {asset_id!r} under {root}")


def typed_fields(df: DataFrame, fields: dict[str, tuple[str, str]], column: str = "value") -> DataFrame:
    """Typed columns of a VARIANT column, given as ``{name: (path, type)}``, for instance ``("$.props.k", "int")``.

    Each field gets a second column ``<name>_other``: the value as JSON text
    where it is there but cannot be read as the type. A value is thus either
    in the one or in the other; a missing field and a JSON null are NULL in both.
    """
    out = []
    for name, (path, kind) in fields.items():
        typed = F.try_variant_get(column, path, kind)
        whole = F.try_variant_get(column, path, "variant")
        other = F.when(typed.isNull() & whole.isNotNull() & ~F.is_variant_null(whole), F.to_json(whole))
        out += [typed.alias(name), other.alias(f"{name}_other")]
    return df.select(*out)


def scan_raw_parquet(spark: SparkSession, root: str, asset_id: str) -> DataFrame:
    path = raw_path(root, asset_id, "parquet")
    if not files.exists(spark, path):
        raise FileNotFoundError(f"no raw Parquet file at {path}")
    return spark.read.parquet(path)


def asset_metadata(df: DataFrame) -> dict | None:
    """The JSON metadata a raw Parquet write stored in the schema."""
    import json

    for f in df.schema.fields:
        if "asset_metadata" in f.metadata:
            return json.loads(f.metadata["asset_metadata"])
    return None


def load_table(spark: SparkSession, tables_root: str, name: str) -> DataFrame:
    """A published dataset; error if absent."""
    table = Table(spark, f"{tables_root.rstrip('/')}/{name}")
    if not table.exists():
        raise FileNotFoundError(f"{table.root} holds no table")
    return table.read()
