"""Helpers shared by the operators: column picking, scratch tables, skew-safe totals."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: space, tab, LF, VT, FF, CR.
SEPARATORS = b" \t\n\x0b\x0c\r"
#: The same as a Java / SQL regular expression class.
SEPARATOR_CLASS = r"[\x20\x09-\x0D]"
#: The other characters.
WORD_CLASS = r"[^\x20\x09-\x0D]"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` reduced to the named columns, as alias=name.

    Names are matched exactly (first match), so extra columns that differ
    only in case, or that carry an operator's own column names, do no harm.
    """
    names = df.columns
    for c in columns.values():
        if c not in names:
            raise ValueError(f"column {c!r} not in {names}")
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"_c{names.index(c)}").alias(a) for a, c in columns.items()])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only for a local master."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    return sc.getCheckpointDir()


def scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_totals(
    df: DataFrame, keys: Sequence[str], totals: dict[str, tuple[Column, str]], salt_on: Sequence[str], having: str = "true", salts: int = 256
) -> DataFrame:
    """``df`` with per-key totals attached, for keys whose totals meet ``having``; no task holds a whole hot key.

    ``totals`` maps a name to (aggregate of rows, SQL function that merges
    such aggregates). Rows are first summed by (key, salt), those sums by
    key, and the totals return to the rows over (key, salt), so a key with a
    third of all rows is spread over ``salts`` join keys. ``df`` is read
    three times: pass a narrow stored table. Keys must not be null.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    part = salted.groupBy(*keys, "_salt").agg(*[a.alias(n) for n, (a, _) in totals.items()])
    whole = part.groupBy(*keys).agg(*[F.expr(f"{merge}({n})").alias(n) for n, (_, merge) in totals.items()])
    back = part.select(*keys, "_salt").join(whole.filter(having), list(keys))
    return salted.join(back, [*keys, "_salt"]).drop("_salt")


def process_cache() -> dict:
    """A dict that lives as long as the Python worker, for read-only helpers that are costly to build."""
    import sys
    import types

    return sys.modules.setdefault("_llm_process_cache", types.ModuleType("_llm_process_cache")).__dict__
