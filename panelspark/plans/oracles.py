"""DuckDB SQL that states each registered query's answer from the raw tables.

The panel oracles restate the pipeline's semantics directly as GROUP BY:
a published row is a (region, month) cell whose region appears in the first
variant's file and that has at least one non-null value.
"""

from __future__ import annotations

from .. import specs
from .fixtures import COUNTY_SUFFIX, GRAINS, SHIFT_MONTHS, VARIANT_AGGS, header_cut

_DIM_SQL = {
    "region": ("JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
               "JOIN region ON n_regionkey = r_regionkey",
               "CAST(r_regionkey AS BIGINT)", "r_name", "r_name"),
    "nation": ("JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
               "JOIN region ON n_regionkey = r_regionkey",
               "CAST(n_nationkey AS BIGINT)", "n_name", "r_name"),
    "customer": ("JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
                 "CAST(c_custkey AS BIGINT)", "printf('%05d', c_custkey)", "n_name"),
    "supplier": ("JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey",
                 "CAST(s_suppkey AS BIGINT)", "s_name || '" + COUNTY_SUFFIX + "'", "n_name"),
    "part": ("JOIN part ON l_partkey = p_partkey", "CAST(p_partkey AS BIGINT)", "p_name", None),
}


def month_sql(ts: str = "o_orderdate") -> str:
    return f"strftime(last_day({ts} + INTERVAL {SHIFT_MONTHS} MONTH), '%Y-%m-%d')"


def fact_sql(grain: str) -> str:
    joins, rid, rname, state = _DIM_SQL[GRAINS[grain].dimension]
    state_sql = f", {state} AS StateName" if GRAINS[grain].has_state else ""
    return (
        f"SELECT {rid} AS RegionID, {rname} AS RegionName{state_sql}, {month_sql()} AS date, "
        "l_extendedprice AS price, o_orderstatus AS status, o_orderpriority AS priority, "
        "l_returnflag AS rflag, l_discount AS discount, "
        "date_diff('day', CAST(o_orderdate AS DATE), last_day(o_orderdate)) AS dtp "
        f"FROM lineitem JOIN orders ON l_orderkey = o_orderkey {joins}"
    )


def header_sql(col: str, grain: str, date: str = "date") -> str:
    """Whether a month is in the header of a variant's file."""
    start, end = header_cut(col, grain)
    bound = f"(SELECT strftime(last_day(date_trunc('month', {{f}}(o_orderdate)) + INTERVAL {{n}} MONTH), '%Y-%m-%d') FROM orders)"
    low, high = bound.format(f="min", n=SHIFT_MONTHS + start), bound.format(f="max", n=SHIFT_MONTHS - end)
    return f"({date} BETWEEN {low} AND {high})"


def seen_sql(agg: str, col: str, grain: str) -> str:
    """A variant's cell: its aggregate where its file has the month."""
    return f"CASE WHEN {header_sql(col, grain)} THEN {agg} END"


def panel_grain_sql(family: str, grain: str, with_grain_col: bool = True) -> str:
    aggs = VARIANT_AGGS[family]
    fam = specs.FAMILIES[family]
    cols = fam.value_columns
    first = cols[0]
    has_state = GRAINS[grain].has_state
    group = "RegionID, RegionName" + (", StateName" if has_state else "") + ", date"
    sel_aggs = ", ".join(f"{seen_sql(aggs[c], c, grain)} AS {c}" for c in cols)
    state_out = ", COALESCE(StateName, '') AS state_code" if has_state and grain != "state" else ""
    any_value = " OR ".join(f"{c} IS NOT NULL" for c in cols)
    grain_col = f"'{grain}' AS grain, " if with_grain_col else ""
    return (
        f"SELECT {grain_col}date, RegionID AS region_id, RegionName AS region_name{state_out}, "
        + ", ".join(cols)
        + f" FROM (SELECT {group}, {sel_aggs} FROM ({fact_sql(grain)}) f GROUP BY {group}) c "
        # the grid is the first variant's regions and months, whatever the others have
        f"WHERE RegionID IN (SELECT RegionID FROM (SELECT RegionID, date, {seen_sql(aggs[first], first, grain)} AS v "
        f"FROM ({fact_sql(grain)}) f1 GROUP BY RegionID, date) WHERE v IS NOT NULL) "
        f"AND {header_sql(first, grain)} AND ({any_value})"
    )


def panel_family_sql(family: str) -> str:
    return "\nUNION ALL BY NAME\n".join(f"({panel_grain_sql(family, g)})" for g in specs.GRAINS)


# --- building blocks for the scan / reshape / join oracles -------------------------
from .fixtures import COUNTRY_ID, COUNTRY_NAME, VARIANT_AGGS_BY_COL  # noqa: E402


def months_sql() -> str:
    """The month header: every month-end from the first to the last order month."""
    return (
        f"SELECT strftime(last_day(d + INTERVAL {SHIFT_MONTHS} MONTH), '%Y-%m-%d') AS date FROM ("
        "SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), "
        "date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS d FROM orders)"
    )


def cells_sql(grain: str, cols: list[str]) -> str:
    """Region-month cells (what the landed wide files hold), incl. the
    national row of the metro file. Columns: RegionID, RegionName, RegionType,
    [StateName], date, <cols>."""
    g = GRAINS[grain]
    fact = fact_sql(grain)
    state = ", StateName" if g.has_state else ""
    ids = f"RegionID, RegionName{state}"
    if g.country_row:
        fact = (f"SELECT * FROM ({fact}) UNION ALL SELECT {COUNTRY_ID}, '{COUNTRY_NAME}'"
                + (", CAST(NULL AS VARCHAR)" if g.has_state else "")
                + f", date, price, status, priority, rflag, discount, dtp FROM ({fact})")
    aggs = ", ".join(f"{seen_sql(VARIANT_AGGS_BY_COL[c], c, grain)} AS {c}" for c in cols)
    rtype = f"CASE WHEN RegionID = {COUNTRY_ID} THEN 'country' ELSE '{g.region_type}' END" if g.country_row \
        else f"'{g.region_type}'"
    return (f"SELECT {ids}, {rtype} AS RegionType, date, {aggs} FROM ({fact}) f "
            f"GROUP BY {ids}, date")


def grid_sql(grain: str, first: str, cols: list[str], extra_ids: str = "") -> str:
    """First variant's regions x its month header, left-joined to the cells."""
    cells = cells_sql(grain, cols)
    return (
        f"SELECT r.RegionID{extra_ids}, m.date, " + ", ".join(f"c.{c}" for c in cols)
        + f" FROM (SELECT DISTINCT RegionID, RegionName, RegionType"
        + (", StateName" if GRAINS[grain].has_state else "")
        + f" FROM ({cells}) WHERE {first} IS NOT NULL) r CROSS JOIN "
        f"(SELECT date FROM ({months_sql()}) WHERE {header_sql(first, grain)}) m "
        f"LEFT JOIN ({cells}) c ON c.RegionID = r.RegionID AND c.date = m.date"
    )
