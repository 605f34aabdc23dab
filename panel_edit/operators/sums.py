"""Sums that do not depend on the order of their rows.

A sum of doubles changes in its last digits with the partitioning, so a test
with an absolute tolerance may pass under one and fail under another. Here
every value is rounded to a whole number of 1e-9 and added as a decimal, which
is exact in any order; the total becomes a double once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Places after the point that are kept, and digits of a value (the sum has ten more).
PLACES, DIGITS = 9, 28


def exact_sum(value: str | Column) -> Column:
    """Sum of the present values, as a double; NULL where there is none.

    Where a value of the group has more than ``DIGITS - PLACES`` digits before
    the point, or is not finite, the group's doubles are added instead.
    """
    column = F.col(value) if isinstance(value, str) else value
    decimal = column.try_cast(f"decimal({DIGITS},{PLACES})")
    return F.when(F.count(decimal) == F.count(column), F.sum(decimal).cast("double")).otherwise(F.sum(column.cast("double")))
