"""Column-level functions (validator predicates and coercions)."""

from .scalars import (  # noqa: F401
    fn_exact_length,
    fn_in_range,
    fn_in_set,
    fn_is_date,
    fn_is_date_any,
    fn_is_month,
    fn_is_quarter,
    fn_is_week,
    fn_is_year,
    fn_lower,
    fn_matches_pattern,
    fn_max_length,
    fn_min_length,
    fn_percentage,
    fn_positive,
    fn_substr_year,
    na_to_null,
    to_double,
)
