"""Declarative data-quality gate computed in one pass.

``dq_report`` turns a schema spec (rows, columns/types, not-null, unique
key) plus a list of value checks into ONE aggregation job:

* all flags and bounds are one global ``agg``, so no row is shuffled;
* a unique key is a second one over 64-bit hashes of the key, full keys being
  compared only where hashes repeat (:func:`unique_violations`).

The report is a DataFrame ``(rule, column, violations, passed, detail)``
built from the one aggregate row with ``inline``; ``validate`` collects
only that report (one row per rule) and raises on failure. Offending
values are fetched only on failure, five per rule, in one scan for all rules.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import specs
from ..functions import scalars as S


# ---------------------------------------------------------------------------
# type names as reported by Arrow, which the type rule matches by substring
def arrow_type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.LongType):
        return "int64"
    if isinstance(dt, T.IntegerType):
        return "int32"
    if isinstance(dt, T.ShortType):
        return "int16"
    if isinstance(dt, T.ByteType):
        return "int8"
    if isinstance(dt, T.DoubleType):
        return "double"
    if isinstance(dt, T.FloatType):
        return "float"
    if isinstance(dt, T.StringType):
        return "string"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, T.DateType):
        return "date32[day]"
    if isinstance(dt, T.TimestampNTZType):
        return "timestamp[us]"
    if isinstance(dt, T.TimestampType):
        return "timestamp[us, tz=UTC]"
    if isinstance(dt, T.DecimalType):
        return f"decimal128({dt.precision}, {dt.scale})"
    if isinstance(dt, T.BinaryType):
        return "binary"
    if isinstance(dt, T.NullType):
        return "null"
    if isinstance(dt, T.ArrayType):
        return f"list<item: {arrow_type_name(dt.elementType)}>"
    if isinstance(dt, T.MapType):
        return f"map<{arrow_type_name(dt.keyType)}, {arrow_type_name(dt.valueType)}>"
    if isinstance(dt, T.StructType):
        return "struct<" + ", ".join(f"{f.name}: {arrow_type_name(f.dataType)}" for f in dt.fields) + ">"
    return dt.simpleString()


# ---------------------------------------------------------------------------
@dataclass
class RowCheck:
    """A per-row validity predicate; NULL input must evaluate to valid."""
    rule: str
    column: str
    valid: Column
    detail: str = ""


@dataclass
class YearBounds:
    """First four characters of the lexicographic min / max of a column."""
    column: str
    min_year: int | None = None
    max_year: int | None = None


@dataclass
class ValueBounds:
    """min / max of the non-null values against bounds (reported, not sampled)."""
    column: str
    lo: Any = None
    hi: Any = None


@dataclass
class Spec:
    columns: dict = field(default_factory=dict)  # name -> expected type substring
    not_null: list = field(default_factory=list)
    unique: list | str | None = None
    min_rows: int | None = None
    max_rows: int | None = None
    checks: list = field(default_factory=list)
    profile_nulls: bool = False  # add an informational null count per column


def _s(v) -> str:
    """SQL literal for a Python value (strings quoted, None as NULL)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _row(rule: str, column: str | None, violations: str, passed: str, detail: str) -> str:
    """One report row as SQL text (all rows are assembled in one expression)."""
    return (f"named_struct('rule', {_s(rule)}, 'column', CAST({_s(column)} AS STRING), "
            f"'violations', CAST({violations} AS BIGINT), 'passed', {passed}, "
            f"'detail', CAST({detail} AS STRING))")


def dq_report(df: DataFrame, spec: Spec) -> DataFrame:
    """All rules as rows: one pass for all flags, and one over the keys alone.

    Report rows and plain aggregates are SQL text (a handful of JVM calls
    in total); only the rules' own predicates are Column expressions."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    static_rows: list[str] = []

    # -- columns and types: driver-side over the schema, no job -------------
    for col, expected in (spec.columns or {}).items():
        if col not in schema:
            static_rows.append(_row("column_exists", col, "1", "FALSE", _s("missing column")))
            continue
        actual = arrow_type_name(schema[col])
        ok = expected in actual
        static_rows.append(_row("column_type", col, "0" if ok else "1", _s(ok),
                                _s(f"expected '{expected}', got '{actual}'")))

    unique = [spec.unique] if isinstance(spec.unique, str) else list(spec.unique or [])
    missing_key = [c for c in unique if c not in schema]
    for c in missing_key:
        static_rows.append(_row("unique", c, "1", "FALSE", _s("missing key column")))
    if missing_key:
        unique = []

    # -- level-1 aggregates ----------------------------------------------------
    flag_aggs: dict[str, Column] = {}
    present_not_null = []
    for col in spec.not_null or []:
        if col not in schema:
            static_rows.append(_row("not_null", col, "1", "FALSE", _s("missing column")))
            continue
        present_not_null.append(col)
        flag_aggs[f"nn__{col}"] = F.expr(f"count_if({_q(col)} IS NULL)")
    profiled = list(schema) if spec.profile_nulls else []
    for i, col in enumerate(profiled):
        flag_aggs[f"pn__{i}"] = F.expr(f"count_if({_q(col)} IS NULL)")
    row_checks = [c for c in spec.checks if isinstance(c, RowCheck)]
    for i, chk in enumerate(row_checks):
        if chk.column not in schema:
            static_rows.append(_row(chk.rule, chk.column, "1", "FALSE", _s("missing column")))
            continue
        flag_aggs[f"rc__{i}"] = F.count_if(~F.coalesce(chk.valid, F.lit(False)))
    bounds = [c for c in spec.checks if isinstance(c, (YearBounds, ValueBounds))]
    minmax: list[str] = []
    for j, chk in enumerate(bounds):
        if chk.column not in schema:
            static_rows.append(_row("bounds", chk.column, "1", "FALSE", _s("missing column")))
            continue
        minmax.append(f"mm__{j}")

    ranges = [F.expr(f"{f}({_q(chk.column)})").alias(f"mm__{j}_{end}")
              for j, chk in enumerate(bounds) if f"mm__{j}" in minmax for f, end in (("min", "lo"), ("max", "hi"))]
    # flags and bounds: one global aggregate, so no row is shuffled
    agg = df.agg(F.count(F.lit(1)).alias("rows"), *[a.alias(k) for k, a in flag_aggs.items()], *ranges)
    if unique:  # only hashes of keys are shuffled, in a job of its own
        agg = agg.withColumn("dups", unique_violations(df, unique).select("duplicates").scalar())

    rows: list[str] = list(static_rows)
    if spec.min_rows:
        m = spec.min_rows
        rows.append(_row("min_rows", None, f"CASE WHEN rows < {m} THEN {m} - rows ELSE 0 END", f"rows >= {m}",
                         f"format_string('expected >= %d rows, got %d', {m}, rows)"))
    if spec.max_rows:
        m = spec.max_rows
        rows.append(_row("max_rows", None, f"CASE WHEN rows > {m} THEN rows - {m} ELSE 0 END", f"rows <= {m}",
                         f"format_string('expected <= %d rows, got %d', {m}, rows)"))
    rows.append(_row("row_count", None, "0", "TRUE", "rows"))
    for col in present_not_null:
        v = _q(f"nn__{col}")
        rows.append(_row("not_null", col, v, f"{v} = 0", f"format_string('%d null values', {v})"))
    if unique:
        rows.append(_row("unique", ",".join(unique), "dups", "dups = 0", "format_string('%d duplicate keys', dups)"))
    for i, col in enumerate(profiled):
        rows.append(_row("null_count", col, f"pn__{i}", "TRUE", "''"))
    for i, chk in enumerate(row_checks):
        if f"rc__{i}" in flag_aggs:
            rows.append(_row(chk.rule, chk.column, f"rc__{i}", f"rc__{i} = 0", _s(chk.detail)))
    for j, chk in enumerate(bounds):
        k = f"mm__{j}"
        if k not in minmax:
            continue
        lo, hi = f"{k}_lo", f"{k}_hi"
        if isinstance(chk, YearBounds):
            ylo = f"TRY_CAST(substring(CAST({lo} AS STRING), 1, 4) AS INT)"
            yhi = f"TRY_CAST(substring(CAST({hi} AS STRING), 1, 4) AS INT)"
            conds = ["TRUE"]
            if chk.min_year is not None:
                conds.append(f"{ylo} >= {chk.min_year}")
            if chk.max_year is not None:
                conds.append(f"{yhi} <= {chk.max_year}")
            # no dates or a non-numeric year prefix fails, as int() would raise
            ok = f"coalesce({' AND '.join(conds)}, FALSE)"
            rows.append(_row("year_bounds", chk.column, f"CASE WHEN {ok} THEN 0 ELSE 1 END", ok,
                             f"format_string('years %s..%s, allowed %s..%s', {ylo}, {yhi}, "
                             f"{_s(str(chk.min_year))}, {_s(str(chk.max_year))})"))
        else:
            conds = ["TRUE"]
            if chk.lo is not None:
                conds.append(f"{lo} >= {_s(chk.lo)}")
            if chk.hi is not None:
                conds.append(f"{hi} <= {_s(chk.hi)}")
            ok = f"coalesce({' AND '.join(conds)}, TRUE)"
            rows.append(_row("min_max_range", chk.column, f"CASE WHEN {ok} THEN 0 ELSE 1 END", ok,
                             f"format_string('min %s max %s', CAST({lo} AS STRING), CAST({hi} AS STRING))"))
    return agg.selectExpr(f"inline(array({', '.join(rows)}))")


class QualityError(AssertionError):
    def __init__(self, failures: list, samples: dict):
        self.failures = failures
        self.samples = samples
        lines = []
        for r in failures:
            s = samples.get((r["rule"], r["column"]))
            lines.append(f"{r['rule']}({r['column']}): {r['violations']} violations; {r['detail']}"
                         + (f"; e.g. {s}" if s else ""))
        super().__init__("quality gate failed: " + " | ".join(lines))


def violations_sample(df: DataFrame, checks: list[RowCheck], n: int = 5) -> DataFrame:
    """(check, rule, column, rank, value): the ``n`` smallest offending values of
    each check as text, NULLs last, from one scan whatever the number of checks.

    Each row yields an entry for each check that it fails; every task keeps
    the ``n`` first of a check before the shuffle (a window group limit), so
    a check that most rows fail costs no more than one that few do.
    """
    if not checks:
        return df.sparkSession.createDataFrame([], "check int, rule string, column string, rank int, value string")
    numbers = range(len(checks))
    failed = F.array(*[F.when(~F.coalesce(c.valid, F.lit(False)), F.lit(i)) for i, c in enumerate(checks)])
    names = list(dict.fromkeys(c.column for c in checks))
    rows = df.select(*[F.col(_q(c)).alias(f"__v{j}") for j, c in enumerate(names)], F.explode(F.array_compact(failed)).alias("check"))
    # a check's own column in its own type: the others are NULL in its entries and do not order them
    own = [F.when(F.col("check").isin([i for i in numbers if checks[i].column == c]), F.col(f"__v{j}")) for j, c in enumerate(names)]
    rows = rows.select("check", *[v.alias(f"__v{j}") for j, v in enumerate(own)])
    order = [F.col(f"__v{j}").asc_nulls_last() for j in range(len(names))]
    rank = F.row_number().over(Window.partitionBy("check").orderBy(*order))
    kept = rows.withColumn("rank", rank).where(F.col("rank") <= n)
    label = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("check") + 1)
    text = F.coalesce(*[F.col(f"__v{j}").cast("string") for j in range(len(names))])
    return kept.select("check", label([c.rule for c in checks]).alias("rule"), label([c.column for c in checks]).alias("column"), "rank", text.alias("value"))


def validate(df: DataFrame, spec: Spec) -> list:
    """Run the gate; return the report rows or raise ``QualityError``.

    On failure one more scan fetches five offending values of each failed row rule.
    """
    report = dq_report(df, spec).collect()
    failures = [r for r in report if not r["passed"]]
    if failures:
        failed = {(r["rule"], r["column"]) for r in failures}
        checks = [c for c in spec.checks if isinstance(c, RowCheck) and (c.rule, c.column) in failed and c.column in df.columns]
        samples: dict = {}
        for r in sorted(violations_sample(df, checks).collect(), key=lambda r: (r["check"], r["rank"])):
            samples.setdefault((r["rule"], r["column"]), []).append(r["value"])
        raise QualityError(failures, samples)
    return report


# ---------------------------------------------------------------------------
# building blocks for specs
def date_format_check(col: str, kind: str = "date") -> RowCheck:
    fn = {"year": S.fn_is_year, "quarter": S.fn_is_quarter, "month": S.fn_is_month,
          "week": S.fn_is_week, "date": S.fn_is_date, "any": S.fn_is_date_any}[kind]
    return RowCheck(f"valid_{kind}", col, fn(col), f"values must be {kind} formatted")


def range_check(col: str, lo=None, hi=None) -> RowCheck:
    return RowCheck("in_range", col, S.fn_in_range(col, lo, hi), f"range [{lo}, {hi}]")


def positive_check(col: str, allow_zero: bool = True) -> RowCheck:
    return RowCheck("positive", col, S.fn_positive(col, allow_zero), ">= 0" if allow_zero else "> 0")


def family_spec(family: specs.Family, df: DataFrame, grain: str, min_rows: int | None = None) -> Spec:
    """The per-family gate: schema, keys, floors, date format, ranges, years."""
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = {"date": "string", "region_id": "int", "region_name": "string"}
    if "state_code" in types and not isinstance(types["state_code"], T.NullType):
        columns["state_code"] = "string"
    for c in family.value_columns:
        if c in types:
            columns[c] = "double"
    floor = family.min_rows.get(grain, family.default_min_rows) if min_rows is None else min_rows
    checks: list = [date_format_check("date")]
    for c in family.positive:
        checks.append(positive_check(c, allow_zero=False))
    for c, (lo, hi) in family.ranges.items():
        if c in types:
            checks.append(range_check(c, lo, hi))
    checks.append(YearBounds("date", family.min_year, family.max_year))
    return Spec(
        columns=columns,
        not_null=list(specs.NOT_NULL_COLUMNS) + list(family.not_null_values),
        unique=list(specs.KEY_COLUMNS),
        min_rows=floor,
        checks=checks,
    )


# ---------------------------------------------------------------------------
# standalone aggregates (also used by the sinks' output profile)
def null_counts(df: DataFrame) -> DataFrame:
    """One row: a null count per column (single pass)."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def unique_violations(df: DataFrame, keys: list[str], hashed: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """(duplicates, distinct_keys, rows): rows minus distinct keys, NULL keys counted as values (not count DISTINCT).

    First only a 64-bit hash of each key is counted, so the shuffle carries
    a long and a partial count, however wide the key. A key whose hash
    occurs once is unique. Full keys are compared just for hashes that
    repeat, where copies and colliding keys are told apart; without such
    hashes the second read finds nothing to join.
    """
    columns = [F.col(_q(k)) for k in keys]
    hashes = df.select(hashed(*columns).alias("__h")).groupBy("__h").agg(F.count(F.lit(1)).alias("__n"))
    repeated = hashes.where(F.col("__n") > 1).select("__h")
    full = df.select(hashed(*columns).alias("__h"), *[c.alias(f"__k{i}") for i, c in enumerate(columns)])
    verified = full.join(repeated, "__h", "left_semi").groupBy(*[f"__k{i}" for i in range(len(keys))]).count()
    found = verified.agg(F.struct(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicates"),
                                  F.count(F.lit(1)).alias("distinct")).alias("v"))
    total = hashes.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("rows"), F.count_if(F.col("__n") == 1).alias("singles"))
    return total.withColumn("v", found.scalar()).select(
        F.col("v.duplicates").alias("duplicates"), (F.col("singles") + F.col("v.distinct")).alias("distinct_keys"), "rows")


def in_set_violations(df: DataFrame, col: str, allowed: DataFrame) -> DataFrame:
    """Membership against a set held as a DataFrame (any size): a left anti
    join, so the set is broadcast only when the planner sizes it as small."""
    allowed = allowed.select(F.col(allowed.columns[0]).alias("__v")).distinct()
    return df.where(F.col(col).isNotNull()).join(allowed, F.col(col) == F.col("__v"), "left_anti")


def bounds_report(df: DataFrame, bounds: dict) -> DataFrame:
    """``(column, min_v, max_v, lo, hi, passed)`` for ``{col: (lo, hi)}`` in one
    aggregate; min/max ignore NULLs like the source's non-null value lists."""
    aggs = []
    for i, c in enumerate(bounds):
        aggs += [F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}")]
    row = df.agg(*aggs)
    structs = []
    for i, (c, (lo, hi)) in enumerate(bounds.items()):
        mn, mx = F.col(f"lo{i}"), F.col(f"hi{i}")
        ok = F.lit(True)
        if lo is not None:
            ok = ok & (mn >= F.lit(lo))
        if hi is not None:
            ok = ok & (mx <= F.lit(hi))
        structs.append(F.struct(F.lit(c).alias("column"), mn.alias("min_v"), mx.alias("max_v"),
                                F.lit(lo).cast("double").alias("lo"), F.lit(hi).cast("double").alias("hi"),
                                F.coalesce(ok, F.lit(True)).alias("passed")))
    return row.select(F.inline(F.array(*structs)))


def year_bounds_report(df: DataFrame, col: str, min_year: int | None, max_year: int | None) -> DataFrame:
    """First four characters of the lexicographic min / max, as ints, vs bounds."""
    row = df.agg(F.min(F.col(col).cast("string")).alias("lo"), F.max(F.col(col).cast("string")).alias("hi"))
    ylo, yhi = S.fn_substr_year(F.col("lo")), S.fn_substr_year(F.col("hi"))
    ok = F.lit(True)
    if min_year is not None:
        ok = ok & (ylo >= min_year)
    if max_year is not None:
        ok = ok & (yhi <= max_year)
    return row.select(ylo.alias("min_year"), yhi.alias("max_year"), F.coalesce(ok, F.lit(False)).alias("passed"))


def violation_examples(df: DataFrame, chk: RowCheck, n: int = 5) -> DataFrame:
    """``(column, violations, rank, value)``: the violation count and the ``n``
    smallest offending values. The sample is a top-n (``TakeOrderedAndProject``),
    never a collect of the offending rows."""
    bad = df.where(~F.coalesce(chk.valid, F.lit(False)))
    violations = bad.count()
    top = bad.select(F.col(chk.column).alias("value")).orderBy(F.col("value").asc_nulls_last()).limit(n)
    ranked = top.agg(F.sort_array(F.collect_list("value")).alias("vals")).select(
        F.posexplode("vals").alias("pos", "value"))
    return ranked.select(F.lit(chk.column).alias("column"), F.lit(violations).cast("long").alias("violations"),
                         (F.col("pos") + 1).alias("rank"), "value")
