"""Scalar column helpers: null-safe division, flags, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """``numerator / denominator`` with NULL (not an ANSI error) for a zero denominator."""
    return F.try_divide(col(numerator), col(denominator))


def is_true(c: str | Column) -> Column:
    """A flag where NULL counts as false (comparisons with missing values are false)."""
    return F.coalesce(col(c), F.lit(False))


def nan_to_null(c: str | Column) -> Column:
    """Map NaN to NULL so that Spark's NaN ordering never flags a missing value."""
    return F.nanvl(col(c), F.lit(None).cast("double"))


def round_to(c: str | Column, digits: int) -> Column:
    return F.round(col(c), digits)
