"""Wide <-> long reshaping and the multi-variant merge.

A wide panel has id columns (any name whose first character is not a
digit) and one column per month (``YYYY-MM-DD`` header). Two merge plans:

* ``merge_variants``: long frames, N-way full outer join on
  (RegionID, date) in one shuffle -- the literal semantics;
  ``merge_variants_packed`` computes it on one row per region, for panels
  whose first variant has no ``RegionType`` column.
* ``melt_multi`` / ``merge_variants_grid``: join *before* melting. Each
  variant's months become one array per region, later variants are
  left-joined onto the first variant's regions (a few thousand wide rows
  instead of millions of long ones) and one ``inline(arrays_zip(...))``
  produces the long rows inside the join's output partitions. This equals
  outer-join + grain filter + drop-all-null (the first variant's grid wins).
"""

from __future__ import annotations

import re
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import to_double
from ..session import scratch

KEY = "RegionID"
HEADER_DATE_RE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def bq(name: str) -> str:
    """Backquoted identifier for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def is_date_header(name: str) -> bool:
    return bool(name) and name[0].isdigit()


def id_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not is_date_header(c)]


def date_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if is_date_header(c)]


def normalize_header_date(name: str) -> str:
    """Normalise one month header on the driver (never per row).

    Headers are validated strictly; a malformed one (e.g. the ``2024-01-312``
    Spark makes of a duplicated header) raises instead of shifting data.
    """
    if not HEADER_DATE_RE.match(name):
        raise ValueError(f"malformed date header {name!r}")
    return datetime.strptime(name, "%Y-%m-%d").strftime("%Y-%m-%d")


def melt(df: DataFrame, value_name: str, var_name: str = "date", ids: list[str] | None = None) -> DataFrame:
    """Wide -> long, NULL cells kept (one ``Expand`` in whole-stage codegen)."""
    ids = ids if ids is not None else id_columns(df)
    months = [c for c in df.columns if c not in ids]
    for m in months:
        normalize_header_date(m)
    if not months:
        return df.select(*ids, F.lit(None).cast("string").alias(var_name),
                         F.lit(None).cast("string").alias(value_name)).limit(0)
    # Normalised header literals become the date values. Per-month expressions
    # are passed as SQL text: one JVM call instead of one per column.
    renamed = df.selectExpr(*[bq(c) for c in ids], *[f"{bq(m)} AS {bq(normalize_header_date(m))}" for m in months])
    return renamed.unpivot(ids, [normalize_header_date(m) for m in months], var_name, value_name)


def _cell(df: DataFrame, name: str, coerce: bool) -> Column:
    c = F.col(f"`{name}`")
    if not coerce:
        return c
    return to_double(c, "string" if dict(df.dtypes)[name] == "string" else "numeric")


def _month_array(df: DataFrame, months: list[str], elem_type: str, coerce: bool = False,
                 raw_by_norm: dict | None = None) -> Column:
    """``array(month cells...)`` over ``months`` (NULL where ``df`` lacks one).
    Built as one SQL expression unless cells are coerced (Column helper)."""
    raw_by_norm = raw_by_norm if raw_by_norm is not None else {m: m for m in df.columns}
    if not coerce:
        parts = [f"CAST({bq(raw_by_norm[m])} AS {elem_type})" if m in raw_by_norm else f"CAST(NULL AS {elem_type})"
                 for m in months]
        return F.expr(f"array({', '.join(parts)})")
    return F.array(*[
        (_cell(df, raw_by_norm[m], coerce).cast(elem_type) if m in raw_by_norm else F.lit(None).cast(elem_type))
        for m in months
    ])


def _elem_type(frames: list[DataFrame]) -> str:
    types = {dict(f.dtypes)[c] for f in frames for c in date_columns(f)}
    return "string" if (not types or "string" in types) else "double"


#: Bytes in memory of a byte of CSV: each cell gets an offset and padding.
CSV_IN_MEMORY = 3


def _small(df: DataFrame) -> bool:
    """Whether a landed variant is surely below the session's broadcast threshold.

    A packed variant's size is no guide for the planner, which counts one
    element per array, so its own choice is kept only where the true size is
    known from the file listing and small; any other variant is joined by a
    shuffle.
    """
    size = getattr(df, "landed_bytes", None)
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size is not None and size * CSV_IN_MEMORY <= threshold


def melt_multi(frames: list[tuple[DataFrame, str]], grain_filter: str | None = None,
               null_safe: bool = True, coerce: bool = False) -> DataFrame:
    """Join-then-melt of several wide variants onto the first one's grid.

    ``frames`` is ``[(wide_df, value_col), ...]``; the first non-empty frame
    supplies the region attributes, its regions (after ``grain_filter`` on
    ``RegionType``) and its month header. Later frames contribute only
    (RegionID, their value). A region missing from a later variant gets an
    all-NULL array so ``arrays_zip`` does not drop its rows; a later variant
    that repeats a RegionID fans out, which the uniqueness gate reports.

    With ``coerce`` cells become doubles (:func:`to_double`) while packing,
    so joined / broadcast arrays hold 8-byte values instead of text. It is
    off by default: one coercion per month column in a single projection
    (hundreds of months) outgrows the JVM's 64 KB method limit, whole-stage
    codegen is abandoned and the stage runs interpreted -- measured 3-6x
    slower than coercing the k value columns after the explode.
    """
    first, first_col = frames[0]
    headers = date_columns(first)
    months = [normalize_header_date(m) for m in headers]
    elem = "double" if coerce else _elem_type([f for f, _ in frames])
    n = len(months)

    base = first
    if grain_filter is not None and "RegionType" in first.columns:
        base = base.where(F.lower(F.col("RegionType")) == F.lit(grain_filter))
    ids = id_columns(first)
    base = base.select(*ids, _month_array(first, months, elem, coerce,
                                          {normalize_header_date(m): m for m in headers}).alias("__v0"))

    joined = base
    for i, (df, _col) in enumerate(frames[1:], start=1):
        raw_by_norm = {normalize_header_date(m): m for m in date_columns(df)}
        arr = _month_array(df, months, elem, coerce, raw_by_norm)
        side = df.select(F.col(KEY).alias(f"__k{i}"), arr.alias(f"__v{i}"))
        if not _small(df):
            side = side.hint("merge")
        cond = (F.col(KEY).eqNullSafe(F.col(f"__k{i}")) if null_safe
                else F.col(KEY) == F.col(f"__k{i}"))
        joined = joined.join(side, cond, "left").drop(f"__k{i}")

    empty = F.array_repeat(F.lit(None).cast(elem), n)
    arrays = [F.lit(months).alias("__d")] + [
        F.coalesce(F.col(f"__v{i}"), empty).alias(f"__v{i}") for i in range(len(frames))
    ]
    zipped = joined.select(*ids, F.inline(F.arrays_zip(*arrays)))
    return zipped.select(
        *ids,
        F.col("__d").alias("date"),
        *[F.col(f"__v{i}").alias(col) for i, (_df, col) in enumerate(frames)],
    )


#: Rows of a key in one variant above which they are spread over several groups.
HOT_ROWS = 10_000
#: Hash buckets of keys that are counted to see whether there can be hot keys.
HOT_BUCKETS = 1 << 16
#: Rows for each partition that the merge is dealt out to: a task sorts them, and alike rows shuffle so small that their bytes say little.
MERGE_ROWS = 400_000


def outer_merge(sides: list[tuple[DataFrame, list[str]]], keys: tuple[str, ...], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Full outer equi-join of any number of frames in one shuffle: the keys, and a struct ``__p<i>`` of each frame's columns.

    All rows go into one tagged union, which is dealt out by key once; a
    group holds each frame's rows of a key, and their combinations are
    generated from it (a frame without the key gives a NULL struct, and
    only repeated keys multiply). NULL keys match NULL keys. The number of
    partitions follows the rows, so that no task sorts more than fit.

    No group grows with a hot key (NULL regions, say): keys that a frame
    holds more than ``hot_rows`` times are found first, by counts of hash
    buckets of keys and then of the keys in full buckets.
    The frame's rows of such a key are spread over slices by a hash, the other
    frames' rows go to every slice; with several hot frames the slices form
    a grid. A combination then meets in exactly one cell.
    """
    n = range(len(sides))
    tagged = []
    for i, (df, columns) in enumerate(sides):
        payloads = []
        for j, (other, names) in enumerate(sides):
            types = T.StructType([other.schema[c] for c in names])
            payloads.append((F.struct(*[F.col(bq(c)) for c in names]) if i == j else F.lit(None).cast(types)).alias(f"__p{j}"))
        tagged.append(df.select(*[F.col(bq(k)) for k in keys], F.lit(i).alias("__i"), *payloads))
    rows = reduce(DataFrame.unionAll, tagged)
    named = [F.col(bq(k)) for k in keys]
    keyed = reduce(DataFrame.unionAll, [df.select(*named, F.lit(i).alias("__i")) for i, (df, _) in enumerate(sides)])
    keyed = keyed.withColumn("__b", F.pmod(F.xxhash64(*named), F.lit(HOT_BUCKETS)).cast("int"))
    many = [F.count(F.lit(1)).alias("__n")]
    found = keyed.groupBy("__b", "__i").agg(*many).agg(F.sum("__n").alias("rows"), F.collect_set(F.when(F.col("__n") > hot_rows, F.col("__b"))).alias("full")).first()
    full = found["full"]
    spread = False
    if full:  # only buckets that are full can hold a hot key
        counts = keyed.where(F.col("__b").isin(full)).groupBy(*named, "__i").agg(*many).where(F.col("__n") > hot_rows)
        spread = not counts.isEmpty()
    slices = [F.max(F.when(F.col("__i") == i, F.ceil(F.col("__n") / hot_rows))).cast("int").alias(f"__s{i}") for i in n]
    by = list(named)
    if spread:
        hot = counts.groupBy(*named).agg(*slices)
        cond = reduce(lambda x, y: x & y, [F.col(bq(k)).eqNullSafe(F.col(f"__h{j}")) for j, k in enumerate(keys)])
        hot = hot.select(*[F.col(bq(k)).alias(f"__h{j}") for j, k in enumerate(keys)], *[F.coalesce(f"__s{i}", F.lit(1)).alias(f"__s{i}") for i in n])
        path = scratch(rows.sparkSession, "outer-merge")  # a stored number for each row, so that a task run again slices alike
        rows.withColumn("__u", F.monotonically_increasing_id()).write.parquet(path)
        rows = rows.sparkSession.read.parquet(path)
        rows = rows.join(hot, cond, "left").drop(*[f"__h{j}" for j in range(len(keys))])
        for i in n:  # a coordinate of the cell for each frame: a row's own is its hash, along the others it is repeated
            size = F.coalesce(F.col(f"__s{i}"), F.lit(1))
            own = F.array(F.pmod(F.xxhash64("__u"), size).cast("int"))
            rows = rows.withColumn(f"__c{i}", F.explode(F.when(F.col("__i") == i, own).otherwise(F.sequence(F.lit(0), size - 1))))
        by += [F.col(f"__c{i}") for i in n]
    dealt = rows.repartition(1 + (found["rows"] or 0) // MERGE_ROWS, *by)
    held = F.collect_list(F.struct("__i", *[f"__p{i}" for i in n])).alias("__rows")
    sizes = [F.max(F.coalesce(F.col(f"__s{i}"), F.lit(1))).alias(f"__s{i}") for i in n] if spread else []
    groups = dealt.groupBy(*by).agg(held, *sizes)
    for i in n:  # as SQL text: a lambda with a default would be taken for one of element and index
        groups = groups.withColumn(f"__p{i}", F.expr(f"filter(__rows, x -> x.__i = {i})"))
    groups = groups.drop("__rows")
    for i in n if spread else ():  # a frame that is spread has its rows in other cells where it has none here
        groups = groups.where((F.col(f"__s{i}") == 1) | (F.size(f"__p{i}") > 0))
    out = groups.select(*named, *[f"__p{i}" for i in n])
    for i in n:
        out = out.withColumn(f"__p{i}", F.explode_outer(f"__p{i}"))
    return out.select(*named, *[F.col(f"__p{i}")[f"__p{i}"].alias(f"__p{i}") for i in n])


def merge_variants(longs: list[tuple[DataFrame, str]], keys: tuple[str, ...] = (KEY, "date"),
                   null_safe: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """N-way full outer equi-join of long frames; later frames keep keys + value.

    One shuffle whatever the number of frames: see :func:`outer_merge`.
    ``null_safe`` (default) matches NULL keys to NULL keys like a pandas
    merge; without it rows with a NULL key pass by, each on its own.
    """
    first, first_col = longs[0]
    own = [c for c in first.columns if c not in keys]
    sides = [(first, own), *[(df, [col]) for df, col in longs[1:]]]
    if len(sides) == 1:
        return first

    def flat(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(bq(c)) if c in keys else F.col("__p0")[c].alias(c) for c in first.columns],
                         *[F.col(f"__p{i}")[col].alias(col) for i, (_df, col) in enumerate(longs) if i])

    if null_safe:
        return flat(outer_merge(sides, keys, hot_rows))
    whole = reduce(lambda a, b: a & b, [F.col(bq(k)).isNotNull() for k in keys])
    merged = flat(outer_merge([(df.where(whole), columns) for df, columns in sides], keys, hot_rows))
    alone = [df.where(~whole).select(*[bq(k) for k in keys], *[bq(c) for c in columns]) for df, columns in sides]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [merged, *alone]).select(*[bq(c) for c in merged.columns])


def merge_variants_packed(frames: list[tuple[DataFrame, str]]) -> DataFrame:
    """The full outer merge of wide variants on (RegionID, date), joined before it is melted.

    Each variant is one row per region with an array over the months of all
    variants, so each join shuffles regions, not cells, and the growing
    result keeps one row per region. Rows whose values are all null are left
    out. As in the merge of long frames, later variants bring keys and
    values only: other columns are set where the first variant has the
    region and the month.
    """
    months = sorted({normalize_header_date(m) for df, _ in frames for m in date_columns(df)})
    elem = _elem_type([f for f, _ in frames])
    first = frames[0][0]
    own = {normalize_header_date(m) for m in date_columns(first)}
    attrs = [c for c in id_columns(first) if c != KEY]
    merged = None
    for i, (df, _col) in enumerate(frames):
        packed = _month_array(df, months, elem, False, {normalize_header_date(m): m for m in date_columns(df)})
        side = df.select(*([F.col(bq(c)) for c in attrs] if i == 0 else []), F.col(KEY).alias(f"__k{i}"), packed.alias(f"__v{i}"))
        if merged is None:
            merged = side.withColumnRenamed("__k0", KEY)
            continue
        if not _small(df):
            side = side.hint("merge")
        joined = merged.join(side, F.col(KEY).eqNullSafe(F.col(f"__k{i}")), "full")
        merged = joined.withColumn(KEY, F.coalesce(F.col(KEY), F.col(f"__k{i}"))).drop(f"__k{i}")
    empty = F.array_repeat(F.lit(None).cast(elem), len(months))
    values = [F.coalesce(F.col(f"__v{i}"), empty).alias(f"__v{i}") for i in range(len(frames))]
    here = F.lit([m in own for m in months]).alias("__own")
    cells = merged.select(KEY, *[F.col(bq(c)) for c in attrs], F.inline(F.arrays_zip(F.lit(months).alias("__d"), here, *values)))
    cells = cells.where(" OR ".join(f"__v{i} IS NOT NULL" for i in range(len(frames))))
    order = [c for c in id_columns(first)]
    return cells.select(
        *[F.col(KEY) if c == KEY else F.when(F.col("__own"), F.col(bq(c))).alias(c) for c in order],
        F.col("__d").alias("date"), *[F.col(f"__v{i}").alias(col) for i, (_df, col) in enumerate(frames)])


def merge_variants_grid(frames: list[tuple[DataFrame, str]], grain_filter: str | None) -> DataFrame:
    """The effective semantics of outer join + grain filter: a left join onto
    the first variant's (region x month) grid, computed join-before-melt."""
    return melt_multi(frames, grain_filter=grain_filter)


def merge_variants_union(frames: list[tuple[DataFrame, str]], grain_filter: str | None) -> DataFrame:
    """``grid="union"``: every region and month of any variant survives, and
    region attributes are coalesced across variants (first non-null wins).
    NULL regions match each other; a repeated region multiplies, which
    ``build_panel`` refuses beforehand."""
    attrs = [c for c in id_columns(frames[0][0]) if c != KEY]
    sides = []
    for df, col in frames:
        long = melt(of_grain(df, grain_filter), col)
        sides.append((long, [*[a for a in attrs if a in long.columns], col]))
    merged = outer_merge(sides, (KEY, "date"))
    first = [F.coalesce(*[F.col(f"__p{i}")[a] for i, (_df, names) in enumerate(sides) if a in names]).alias(a) for a in attrs]
    return merged.select(KEY, "date", *first, *[F.col(f"__p{i}")[col].alias(col) for i, (_df, col) in enumerate(frames)])


def of_grain(df: DataFrame, grain_filter: str | None) -> DataFrame:
    """The rows of a grain, where the frame tells."""
    if grain_filter is None or "RegionType" not in df.columns:
        return df
    return df.where(F.lower(F.col("RegionType")) == F.lit(grain_filter))
