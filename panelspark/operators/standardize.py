"""Standardisation of a merged long panel.

Order of steps (same as the source pipeline): grain filter, rename, drop,
state_code, date format, numeric coercion, drop all-NULL rows, sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import specs
from ..functions.scalars import to_double

RENAMES = {"RegionID": "region_id", "RegionName": "region_name", "StateName": "state_code"}
DROPS = ["SizeRank", "RegionType"]


def filter_grain(df: DataFrame, grain: str) -> DataFrame:
    """``lower(RegionType) = filter`` only when the column exists; NULL never matches."""
    if "RegionType" not in df.columns:
        return df
    return df.where(F.lower(F.col("RegionType")) == F.lit(specs.GRAIN_FILTER[grain]))


def rename_cols(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns})


def drop_cols(df: DataFrame) -> DataFrame:
    return df.drop(*DROPS)


def state_code_fill(df: DataFrame, grain: str) -> DataFrame:
    if "state_code" not in df.columns:
        return df
    if grain == "state":
        return df.drop("state_code")
    return df.withColumn("state_code", F.coalesce(F.col("state_code").cast("string"), F.lit("")))


def date_normalize(df: DataFrame, col: str = "date") -> DataFrame:
    """Per-row fallback; melted frames already carry normalised header literals."""
    return df.withColumn(col, F.date_format(F.to_date(F.col(col)), "yyyy-MM-dd"))


def to_numeric_coerce(df: DataFrame, value_cols: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({
        c: to_double(c, "string" if types[c] == "string" else types[c])
        for c in value_cols if c in types
    })


def dropna_all(df: DataFrame, value_cols: list[str]) -> DataFrame:
    present = [c for c in value_cols if c in df.columns]
    return df.dropna(how="all", subset=present) if present else df


def sort_output(df: DataFrame) -> DataFrame:
    """Global order (date, region_name), NULLs last. Tables are written
    rebalanced and sorted within files instead (``Table(sort_by=...)``), so
    no write funnels through a global sort."""
    return df.orderBy(F.col("date").asc_nulls_last(), F.col("region_name").asc_nulls_last())


def write_sorted(df: DataFrame, path: str, by: list[str], files: int | None = None) -> None:
    """Files whose ranges of ``by`` (NULLs last) follow each other, each in order: one range-partitioned shuffle,
    sorted within the tasks that write. ``files`` is their number; by default they get Spark's advisory size."""
    order = [F.col(f"`{c}`").asc_nulls_last() for c in by]
    df.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order).write.parquet(path)


def sorted_proof(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """One row (files, rows, unordered_files, overlaps): whether the files of a folder are in order as they stand.

    One scan gives each file's least and greatest key, and the keys of its
    first and last row, which must be the same (between them a file is as
    its task sorted it). Files in the order of their least key must not begin
    below the end of the one before. No rows are sorted: only a row for
    each file (or split of a file) is.
    """
    key = F.struct(*[x for c in by for x in (F.col(f"`{c}`").isNull().alias(f"{c}__null"), F.col(f"`{c}`"))])
    parts = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), key.alias("key"))
    # the first and the last row by place, against the least and the greatest by key
    bounds = parts.groupBy("file", "block").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count(F.lit(1)).alias("rows"),
                                                F.min_by("key", "at").alias("first"), F.max_by("key", "at").alias("last"))
    before = F.max("hi").over(Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    return bounds.withColumn("before", before).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
        F.count_if((F.col("first") != F.col("lo")) | (F.col("last") != F.col("hi"))).alias("unordered_files"),
        F.count_if(F.col("lo") < F.col("before")).alias("overlaps"))



def standardize(df: DataFrame, grain: str, value_cols: list[str], *, region_id_type: str = "bigint",
                normalize_dates: bool = False) -> DataFrame:
    df = filter_grain(df, grain)
    df = rename_cols(df)
    df = drop_cols(df)
    df = state_code_fill(df, grain)
    if "region_id" in df.columns and dict(df.dtypes)["region_id"] != region_id_type:
        df = df.withColumn("region_id", F.col("region_id").try_cast(region_id_type))
    if normalize_dates:
        df = date_normalize(df)
    df = to_numeric_coerce(df, value_cols)
    return dropna_all(df, value_cols)
