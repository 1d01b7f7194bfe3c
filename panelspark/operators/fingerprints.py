"""Order-free fingerprints of stored tables: a tree of sums from buckets of rows over partitions to the whole.

A row's fingerprint is a pair of 64-bit hashes of its values and of the
names of its columns that are not NULL. A leaf holds, for the rows of a
partition that share a bucket (a few bits of the hash), their number and
the sums of both hashes; sums of leaves are the fingerprints of partitions
and of the table. They do not depend on the order of rows or columns, count
copies, add up (an append only adds leaves), and a column that is NULL
everywhere changes nothing.

Comparing two stored tables reads their leaves. Equal partitions are then
not scanned, and of the others only rows in differing buckets are shuffled.
Equal leaves are taken for equal rows: two different sets of rows would
have to agree in the count and in 128 bits of sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of a partition: a changed row brings the rows of one bucket of its partition into the comparison.
BUCKETS = 64


def _hashes(columns: list[str]) -> tuple[Column, Column]:
    ordered = sorted(columns)
    cells = [F.col(_q(c)) for c in ordered]
    # hashes pass over NULLs, so which columns have a value is hashed, too
    present = F.concat_ws(",", *[F.when(F.col(_q(c)).isNotNull(), F.lit(_q(c))) for c in ordered])
    return F.xxhash64(present, *cells), F.xxhash64(F.lit("second"), *cells, present)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def bucket(columns: list[str]) -> Column:
    """The bucket of a row among its partition's."""
    return F.pmod(F.shiftright(_hashes(columns)[0], 17), F.lit(BUCKETS)).cast("int")


def fingerprints(df: DataFrame, part: str) -> DataFrame:
    """(bucket, rows, h1, h2, ``part``): the leaves of ``df``, of which ``part`` is the partition column. Rows are summed before the shuffle."""
    columns = [c for c in df.columns if c != part]
    h1, h2 = _hashes(columns)
    hashed = df.select(F.col(_q(part)), bucket(columns).alias("bucket"), h1.alias("h1"), h2.alias("h2"))
    sums = [F.sum(F.col(h).cast("decimal(28,0)")).cast("decimal(38,0)").alias(h) for h in ("h1", "h2")]
    return hashed.groupBy(part, "bucket").agg(F.count(F.lit(1)).alias("rows"), *sums).select("bucket", "rows", "h1", "h2", part)


def differing(new: DataFrame, old: DataFrame, part: str) -> DataFrame:
    """(``part``, bucket) of the leaves that differ between two tables' stored fingerprints: one signed sum over both."""
    sides = [df.select(part, "bucket", *[(F.col(c) * sign).cast("decimal(38,0)").alias(c) for c in ("rows", "h1", "h2")]) for df, sign in ((new, 1), (old, -1))]
    net = sides[0].unionByName(sides[1]).groupBy(part, "bucket").agg(*[F.sum(c).alias(c) for c in ("rows", "h1", "h2")])
    return net.where("rows != 0 OR h1 != 0 OR h2 != 0").select(part, "bucket")
