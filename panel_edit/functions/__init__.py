"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from panel_edit.functions.columns import is_true, nan_to_null, ratio, round_to
from panel_edit.functions.lists import (
    contains_period,
    ensure_list,
    next_free_year,
    parse_year_list,
    previous_free_year,
)

__all__ = [
    "contains_period",
    "ensure_list",
    "is_true",
    "nan_to_null",
    "next_free_year",
    "parse_year_list",
    "previous_free_year",
    "ratio",
    "round_to",
]
