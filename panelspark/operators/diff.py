"""Table comparison: has-changed, row-level diff, key-level state diff.

Distributed rows have no order, so equality is multiset equality
(``exceptAll`` both ways), not a comparison of serialised text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fingerprints import bucket, differing

PART = "__part"


def _aligned(new: DataFrame, old: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    if sorted(new.dtypes) != sorted(old.dtypes):
        return None
    return new, old.select(*new.columns)


def table_changed(new: DataFrame, old: DataFrame | None) -> bool:
    """Row count, then schema, then content. A missing old table is a change.

    Content: one job computes, per side, the count and an order-free
    fingerprint (sum of a 64-bit row hash). Different fingerprints decide;
    equal ones are confirmed exactly by the signed multiset count of
    :func:`_net_rows` (``limit(1)``: the first surviving row ends the scan).
    """
    if old is None:
        return True
    aligned = _aligned(new, old)
    if aligned is None:
        return True
    new, old = aligned
    h = F.xxhash64(*[F.col(f"`{c}`") for c in new.columns]).cast("decimal(38,0)")
    both = (new.select(F.lit("new").alias("__side"), h.alias("__h"))
            .unionByName(old.select(F.lit("old").alias("__side"), h.alias("__h"))))
    fp = {r["__side"]: (r["n"], r["h"]) for r in
          both.groupBy("__side").agg(F.count(F.lit(1)).alias("n"), F.sum("__h").alias("h")).collect()}
    if fp.get("new", (0, None)) != fp.get("old", (0, None)):
        return True
    return _net_rows(new, old).limit(1).count() > 0


def _net_rows(new: DataFrame, old: DataFrame) -> DataFrame:
    """Distinct rows whose multiplicity differs: ``__n`` = count(new) - count(old)."""
    cols = [f"`{c}`" for c in new.columns]
    tagged = (new.select(*cols, F.lit(1).alias("__w"))
              .unionByName(old.select(*cols, F.lit(-1).alias("__w"))))
    return tagged.groupBy(*cols).agg(F.sum("__w").alias("__n")).where(F.col("__n") != 0)


def table_diff(new: DataFrame, old: DataFrame, chunk: int = 10000) -> DataFrame:
    """Rows added (``+``) and removed (``-``), duplicates counted (EXCEPT ALL
    both ways) in ONE aggregation: every row is tagged +1 (new) or -1 (old),
    summed per distinct row (NULLs group together, map-side partial sums
    collapse hot duplicates), and a non-zero net count is replicated back
    into that many rows -- with one shuffle and one scan per side instead of
    two each.

    Replication is bounded: each distinct row becomes ceil(n / ``chunk``)
    chunk records (one in the usual case), the chunk records are rebalanced
    over tasks -- the only extra shuffle, over the differing rows alone --
    and each chunk expands to at most ``chunk`` rows. A group of copies
    holding a big share of the table is thus spread over many tasks instead
    of one task materialising and emitting all of it.
    """
    cols = [f"`{c}`" for c in new.columns]
    net = _net_rows(new, old.select(*cols))
    m = F.abs(F.col("__n"))
    chunks = net.select(
        *cols,
        F.when(F.col("__n") > 0, F.lit("+")).otherwise(F.lit("-")).alias("change"),
        m.alias("__m"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((m - 1) / chunk).cast("long"))).alias("__c"))
    size = F.least(F.lit(chunk).cast("long"), F.col("__m") - F.col("__c") * chunk).cast("int")
    return (chunks.hint("rebalance")
            .select(*cols, "change", F.explode(F.array_repeat(F.lit(1), size)).alias("__x"))
            .drop("__x"))


def _leaves(new, old) -> DataFrame:
    """(__part, bucket) where two stored tables differ; tables that are partitioned differently are compared by bucket alone."""
    sides = [t.read_fingerprints() for t in (new, old)]
    if (new.partition_col, new.partition_fn) != (old.partition_col, old.partition_fn):
        sides = [s.withColumn(PART, F.lit(None).cast("string")) for s in sides]
    return differing(*sides, PART)


def stored_changed(new, old) -> bool:
    """Whether two tables that keep fingerprints differ, in columns or rows: only their fingerprints are read."""
    if sorted(new.read(with_comments=False).dtypes) != sorted(old.read(with_comments=False).dtypes):
        return True
    return not _leaves(new, old).isEmpty()


def stored_diff(new, old) -> DataFrame:
    """:func:`table_diff` of two tables that keep fingerprints.

    The leaves of both trees are compared first (a few numbers for each
    partition). Only partitions with a differing leaf are scanned, and only
    rows in differing buckets of theirs reach the shuffle.
    """
    a, b = (t.read(with_comments=False, partition=True) for t in (new, old))
    names = [c for c in a.columns if c != PART]
    if sorted(x for x in a.dtypes if x[0] != PART) != sorted(x for x in b.dtypes if x[0] != PART):
        raise ValueError("the tables have different columns")
    leaves = _leaves(new, old)
    spark = leaves.sparkSession
    found = spark.createDataFrame(leaves.collect(), leaves.schema)  # at most partitions x buckets
    by_part = all(PART in df.columns for df in (a, b)) and (new.partition_col, new.partition_fn) == (old.partition_col, old.partition_fn)
    parts = {r[PART] for r in found.collect()}
    among = F.col(PART).isin([p for p in parts if p is not None]) | (F.col(PART).isNull() if None in parts else F.lit(False))

    def open_rows(df: DataFrame) -> DataFrame:
        df = df.where(among) if by_part else df.withColumn(PART, F.lit(None).cast("string"))
        keyed = df.withColumn("__bucket", bucket(names)).withColumn("__key", F.coalesce(F.col(PART), F.lit("")))
        wanted = found.select(F.col("bucket").alias("__bucket"), F.coalesce(F.col(PART), F.lit("")).alias("__key"))
        return keyed.join(wanted, ["__bucket", "__key"], "left_semi").select(*[f"`{c}`" for c in names])

    return table_diff(open_rows(a), open_rows(b))


def state_diff(old: DataFrame, new: DataFrame, key: str = "key", value: str = "value",
               exclude: tuple[str, ...] = ("_metadata",)) -> DataFrame:
    """Keys whose value differs between two key/value state tables, with old
    and new values as strings ('' for a missing or NULL value). Full outer
    join on the key; NULL-safe inequality picks the changes."""
    o = old.select(F.col(key).alias("key"), F.col(value).cast("string").alias("old_value"))
    n = new.select(F.col(key).alias("key"), F.col(value).cast("string").alias("new_value"))
    if exclude:
        o = o.where(~F.col("key").isin(list(exclude)))
        n = n.where(~F.col("key").isin(list(exclude)))
    joined = o.join(n, "key", "full")
    return (joined.where(~F.col("old_value").eqNullSafe(F.col("new_value")))
            .select("key", F.coalesce("old_value", F.lit("")).alias("old_value"),
                    F.coalesce("new_value", F.lit("")).alias("new_value")))
