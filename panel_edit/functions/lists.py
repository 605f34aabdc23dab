"""Expressions over the analyst's list of periods to correct.

A list cell is ``array<int>``; these replace per-row Python helpers with
higher-order functions evaluated inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panel_edit.functions.columns import col


def ensure_list(c: str | Column) -> Column:
    """NULL list -> empty list."""
    return F.coalesce(col(c), F.array().cast("array<int>"))


def parse_year_list(c: str | Column) -> Column:
    """Parse a cell such as ``"2010, 2011"`` / ``"2012.0"`` / NULL into ``array<int>``.

    Spaces are removed, the text is split on commas, empty items and ``nan``
    are dropped, each item is read as a number and truncated to int. An item
    that is not a number raises (ANSI cast), as a bad analyst entry should.
    """
    text = F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), " ", "")
    items = F.filter(F.split(text, ","), lambda x: (x != "") & (F.lower(x) != "nan"))
    return F.transform(items, lambda x: x.cast("double").cast("int"))


def contains_period(listed: str | Column, period: str | Column) -> Column:
    """Is the row's period in its list (NULL list = no)."""
    return F.coalesce(F.array_contains(col(listed), col(period)), F.lit(False))


def next_free_year(period: str | Column, listed: str | Column, limit: int | Column) -> Column:
    """First year >= period that is not listed, never beyond ``limit + 1``."""
    y, lst = col(period), ensure_list(listed)
    stop = (limit if isinstance(limit, Column) else F.lit(limit)) + 1
    free = F.filter(F.sequence(y, stop), lambda k: ~F.array_contains(lst, k))
    return F.when(~F.array_contains(lst, y) | (y >= stop), y).otherwise(
        F.coalesce(F.array_min(free), stop)
    )


def previous_free_year(period: str | Column, listed: str | Column, limit: int | Column) -> Column:
    """Last year <= period that is not listed, never before ``limit - 1``."""
    y, lst = col(period), ensure_list(listed)
    stop = (limit if isinstance(limit, Column) else F.lit(limit)) - 1
    free = F.filter(F.sequence(stop, y), lambda k: ~F.array_contains(lst, k))
    return F.when(~F.array_contains(lst, y) | (y <= stop), y).otherwise(
        F.coalesce(F.array_max(free), stop)
    )
