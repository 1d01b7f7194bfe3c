"""A table as a folder of Parquet files: append / overwrite / upsert as Spark writes.

    <root>/data/<id>/[__part=<value>/]part-*.parquet
    <root>/_table.json      which data folder is current, its columns, partitioning and metadata

* overwrite writes a fresh folder and points to it;
* append adds files to the current folder (Spark's append mode); columns
  that are new are NULL in older files;
* a merge of a partitioned table reads the partitions that the source
  touches, upserts, and replaces just those with Spark's dynamic partition
  overwrite: folders of other partitions keep their files. A merge that is
  not keyed by the partition column rewrites the table into a fresh folder.

``stage`` + ``commit`` give write-audit-publish: the panel is written
once, the quality gate reads the written files (no recomputation, and
lineage is cut, so a lost executor re-reads files instead of re-running
the pipeline) and only a passing table is pointed to or merged. Row and
null counts are observed by the write itself.

A table has one writer at a time. Replacing the definition is one rename;
a dynamic overwrite moves its partition folders one after the other when
its job commits, so readers should not read a table that is being merged.
With ``fingerprints`` the writes keep the order-free sums of
:mod:`panelspark.operators.fingerprints` beside the data.
"""

from __future__ import annotations

import json
import uuid
import warnings
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.fingerprints import fingerprints
from ..sources import files

MODES = ("append", "overwrite", "merge")

PART = "__part"


class MergeKeyError(ValueError):
    pass


@dataclass
class Staged:
    """A written data folder that the table does not point to, and what its write observed."""
    path: str
    schema: T.StructType
    rows: int
    nulls: dict[str, int]


class Table:
    """A table, optionally partitioned by ``partition_fn`` applied to
    ``partition_col`` (SQL text with ``{}`` for the column, e.g.
    ``"substring({}, 1, 4)"`` for the year of a date string). The partitioning
    is kept in the table's definition, so reopening needs no arguments.
    """

    def __init__(self, spark: SparkSession, root: str, partition_col: str | None = None,
                 partition_fn: str = "{}", sort_by: list[str] | None = None, fingerprints: bool = False):
        self.spark = spark
        self.sort_by = list(sort_by or [])
        self.root = root.rstrip("/")
        self.partition_col = partition_col
        self.partition_fn = partition_fn
        self.fingerprints = fingerprints
        cur = self.definition()
        if cur is not None:
            self.partition_col, self.partition_fn = cur["partition_col"], cur["partition_fn"]
            self.fingerprints = cur["fingerprints"]

    @property
    def partitioned(self) -> bool:
        return self.partition_col is not None

    # -- definition -------------------------------------------------------------
    def definition(self) -> dict | None:
        """Folder, columns, partitioning and metadata of the table; None before its first write."""
        path = f"{self.root}/_table.json"
        return json.loads(files.read_text(self.spark, path)) if files.exists(self.spark, path) else None

    def _define(self, folder: str, schema: T.StructType, metadata: dict | None) -> None:
        files.write_text(self.spark, f"{self.root}/_table.json", json.dumps({
            "folder": folder.rsplit("/", 1)[1], "schema": schema.json(), "metadata": metadata, "fingerprints": self.fingerprints,
            "partition_col": self.partition_col, "partition_fn": self.partition_fn}), overwrite=True)

    def _current(self) -> dict:
        cur = self.definition()
        if cur is None:
            raise FileNotFoundError(f"no table at {self.root}")
        return cur

    def exists(self) -> bool:
        return files.exists(self.spark, f"{self.root}/_table.json")

    def folder(self) -> str:
        return f"{self.root}/data/{self._current()['folder']}"

    def schema(self) -> T.StructType:
        """Columns of the table, from its definition: no file is opened."""
        return T.StructType.fromJson(json.loads(self._current()["schema"]))

    def columns(self) -> list[str]:
        return self.schema().names

    def metadata(self) -> dict | None:
        return self._current()["metadata"]

    def set_metadata(self, metadata: dict) -> None:
        self._define(self.folder(), self.schema(), metadata)

    # -- read -------------------------------------------------------------------
    def _read(self, folder: str, schema: T.StructType, partition: bool = False) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField(PART, T.StringType())]) if self.partitioned else schema
        df = self.spark.read.schema(whole).parquet(folder)
        return df if partition or not self.partitioned else df.drop(PART)

    def read(self, with_comments: bool = True, partition: bool = False) -> DataFrame:
        """The table; with ``partition`` also its partition column ``__part``, a
        filter on which leaves out whole folders."""
        df = self._read(self.folder(), self.schema(), partition)
        descs = (self.metadata() or {}).get("column_descriptions") or {} if with_comments else {}
        for c, d in (json.loads(descs) if isinstance(descs, str) else descs).items():
            if c in df.columns:
                df = df.withMetadata(c, {"comment": d})
        return df

    def read_fingerprints(self) -> DataFrame:
        """(__part, bucket, rows, h1, h2), to be summed: see :mod:`panelspark.operators.fingerprints`."""
        folder = f"{self.folder()}{FINGERPRINTS}"
        if not self.fingerprints:
            raise FileNotFoundError(f"{self.root} keeps no fingerprints")
        return self.spark.read.schema(f"bucket int, rows long, h1 decimal(38,0), h2 decimal(38,0), {PART} string").parquet(folder)

    def read_staged(self, staged: Staged) -> DataFrame:
        """The rows of a staged folder, as the table will expose them; no rows if nothing was written."""
        return self._read(staged.path, staged.schema)

    # -- write ------------------------------------------------------------------
    def _parted(self, df: DataFrame) -> DataFrame:
        # an empty text is stored as NULL by Spark's partitioned writes
        part = F.expr(f"nullif(CAST({self.partition_fn.format(_quoted(self.partition_col))} AS STRING), '')")
        return df.withColumn(PART, part)

    def _write(self, df: DataFrame, path: str, mode: str = "errorifexists", observed: Observation | None = None) -> None:
        """Rebalance on the partition value (AQE splits a hot partition, merges
        small ones) so each partition gets few, full files; then sort within
        files by ``sort_by`` (NULLs last) for tight min/max statistics."""
        order = [F.col(_quoted(c)).asc_nulls_last() for c in self.sort_by]
        names = df.columns
        out = self._parted(df).hint("rebalance", PART) if self.partitioned else df.hint("rebalance") if order else df
        out = out.sortWithinPartitions(*order) if order else out
        if observed is not None:  # in the stage that writes, where each row counts once
            out = out.observe(observed, F.count(F.lit(1)).alias("rows"),
                              *[F.count_if(F.col(_quoted(c)).isNull()).alias(f"n{i}") for i, c in enumerate(names)])
        writer = out.write.mode("overwrite" if mode == "dynamic" else mode)
        if mode == "dynamic":
            writer = writer.option("partitionOverwriteMode", "dynamic")
        (writer.partitionBy(PART) if self.partitioned else writer).parquet(path)

    def _keep_sums(self, df: DataFrame, path: str, mode: str) -> None:
        """The fingerprints of ``df``, whose rows were written to ``path`` by ``mode``."""
        if not self.fingerprints:
            return
        sums = fingerprints(self._parted(df) if self.partitioned else df.withColumn(PART, F.lit(None).cast("string")), PART)
        writer = sums.write.mode("overwrite" if mode == "dynamic" else mode).partitionBy(PART)
        (writer.option("partitionOverwriteMode", "dynamic") if mode == "dynamic" else writer).parquet(f"{path}{FINGERPRINTS}")

    def stage(self, df: DataFrame) -> Staged:
        """Write ``df`` to a fresh data folder that the table does not point to yet."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        seen = Observation()
        self._write(df, path, observed=seen)
        found = seen.get
        return Staged(path, df.schema, found["rows"], {c: found[f"n{i}"] for i, c in enumerate(df.columns)})

    def write(self, df: DataFrame, mode: str = "append", key: list[str] | str | None = None,
              metadata: dict | None = None) -> Staged | None:
        check_mode(mode, key)
        if mode == "overwrite":
            warnings.warn(f"overwriting {self.root}: all existing data will be replaced", stacklevel=2)
        staged = self.stage(df)  # the plan runs once
        if not staged.rows:
            return None  # zero rows: no-op in every mode, overwrite included (folder stays unreferenced)
        self.commit(staged, mode, key, metadata)
        return staged

    def commit(self, staged: Staged, mode: str = "append", key: list[str] | str | None = None,
               metadata: dict | None = None, keys_unique: bool = False) -> None:
        """Make a staged folder (part of) the table. ``keys_unique`` skips the
        merge's duplicate-source-key pass when the caller has already proven
        the key unique (the quality gate does)."""
        check_mode(mode, key)
        cur = self.definition()
        metadata = metadata if metadata is not None else (cur or {}).get("metadata")
        new = self.read_staged(staged)
        if cur is None or mode == "overwrite":
            self._keep_sums(new, staged.path, "errorifexists")
            return self._define(staged.path, staged.schema, metadata)
        folder, old = self.folder(), self.schema()
        whole = evolved(old, staged.schema)
        if mode == "append":
            self._write(new, folder, "append")
            self._keep_sums(new, folder, "append")
            return self._define(folder, whole, metadata)
        keys = [key] if isinstance(key, str) else list(key)
        target = self._read(folder, old, partition=True)
        if not self.partitioned or self.partition_col not in keys:
            # a source row can match a target row of any partition: all of it is rewritten
            fresh = f"{self.root}/data/{uuid.uuid4().hex}"
            self._write(upsert(target.drop(PART), new, keys, check_duplicates=not keys_unique), fresh)
            self._keep_sums(self._read(fresh, whole), fresh, "errorifexists")
            return self._define(fresh, whole, metadata)
        touched = [r[0] for r in self._read(staged.path, staged.schema, partition=True).select(PART).distinct().collect()]
        among = F.col(PART).isin([t for t in touched if t is not None]) | (F.col(PART).isNull() if None in touched else F.lit(False))
        self._write(upsert(target.where(among).drop(PART), new, keys, check_duplicates=not keys_unique), folder, "dynamic")
        self._keep_sums(self._read(folder, whole, partition=True).where(among).drop(PART), folder, "dynamic")
        self._define(folder, whole, metadata)


#: A data folder's fingerprints stand beside it, under its name and this.
FINGERPRINTS = "-fingerprints"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def evolved(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns, then new ones; a column that changes its type is refused."""
    for f in new.fields:
        if f.name in old.names and old[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name!r} is {old[f.name].dataType.simpleString()} in the table, "
                             f"{f.dataType.simpleString()} in the new rows")
    return T.StructType(old.fields + [f for f in new.fields if f.name not in old.names])


def check_mode(mode: str, key) -> None:
    """Refuses an unknown write mode, and an upsert that names no key."""
    if mode == "merge" and not key:
        raise ValueError("an upsert needs a key")
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}; known: {', '.join(MODES)}")


def duplicate_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once in the source (partial-aggregated).
    Rows with a NULL key part never match a target row, so they cannot
    conflict and are not counted."""
    complete = source
    for k in keys:
        complete = complete.where(F.col(f"`{k}`").isNotNull())
    return complete.groupBy(*keys).count().where(F.col("count") > 1)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], check_duplicates: bool = True) -> DataFrame:
    """MERGE semantics: matched rows take the source's columns and keep
    target-only columns; unmatched source rows are inserted (target-only
    columns NULL); unmatched target rows stay.

    NULL keys never match (SQL equality): such rows pass by the joins. The
    others meet in a left join from the source and an anti join from the
    target, so AQE can split a key that the target repeats (it cannot split
    a full outer join).
    """
    if check_duplicates and duplicate_keys(source, keys).limit(1).count() > 0:
        raise MergeKeyError(f"source has duplicate rows for merge key {keys}")
    types = {f.name: f.dataType for f in (*source.schema.fields, *target.schema.fields)}
    order = [*target.columns, *[c for c in source.columns if c not in target.columns]]

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in order])

    def keyed(df: DataFrame, whole: bool) -> DataFrame:
        has = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
        return df.where(has if whole else ~has)

    t = keyed(target, True)
    s = keyed(source, True)
    kept = t.join(s.select(*keys), keys, "left_anti")
    own = [c for c in target.columns if c not in source.columns]
    old = t.select(*[F.col(f"`{c}`").alias(f"t__{c}") for c in (*keys, *own)])
    on = reduce(lambda a, b: a & b, [F.col(f"`{k}`") == F.col(f"t__{k}") for k in keys])
    new = s.join(old, on, "left").select(*source.columns, *[F.col(f"t__{c}").alias(c) for c in own])
    return reduce(DataFrame.unionAll, [shaped(x) for x in (kept, new, keyed(target, False), keyed(source, False))])
