"""Data-quality checks.

Each check is a query returning its violations, so it can run as a report on
its own; ``require`` turns it into a job failure that states how many there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panel_edit.operators.sums import exact_sum


class CheckFailed(ValueError):
    """A data-quality check found violations."""


#: Violations that an error message shows beside their total.
SHOWN = 10


def require(violations: DataFrame, message: str, show: int = SHOWN) -> None:
    """Raise ``CheckFailed`` if ``violations`` has any row; the message gives the total and ``show`` rows."""
    sample = violations.take(show)
    if sample:
        total = len(sample) if len(sample) < show else violations.count()
        listed = ", ".join(str(tuple(r)) for r in sample)
        raise CheckFailed(f"{message}: {total} rows, of them {listed}")


def sum_mismatches(
    df: DataFrame,
    keys: Sequence[str],
    before: str,
    after: str,
    tolerance: float = 1e-6,
    relative: float = 0.0,
) -> DataFrame:
    """Groups whose totals of ``before`` and ``after`` differ by more than the tolerance.

    A sum over only NULLs is 0, and no sum depends on the order of its rows. The allowed difference is
    ``tolerance + relative * |total before|``; ``relative=0`` is the strict
    absolute test.
    """
    totals = df.groupBy(*keys).agg(
        F.coalesce(exact_sum(before), F.lit(0.0)).alias("sum_before"),
        F.coalesce(exact_sum(after), F.lit(0.0)).alias("sum_after"),
    )
    diff = F.abs(F.col("sum_before") - F.col("sum_after"))
    allowed = F.lit(tolerance) + F.lit(relative) * F.abs(F.col("sum_before"))
    return totals.withColumn("difference", diff).where(~(diff <= allowed))


def zero_totals(df: DataFrame, keys: Sequence[str], total: str) -> DataFrame:
    """Distinct groups whose ``total`` is exactly zero."""
    return df.where(F.col(total) == 0).select(*keys).distinct()


def negatives(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value) < 0)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (a pivot or lookup on them would be ambiguous)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def absent_columns(df: DataFrame, present: Sequence[str]) -> DataFrame:
    """Columns of ``df`` that are not among ``present``, with the number of values they hold: (column, n_values)."""
    absent = [c for c in df.columns if c not in present]
    if not absent:
        return df.sparkSession.createDataFrame([], "column string, n_values bigint")
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(absent)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("n_values")) for i, c in enumerate(absent)])))


def duplicate_years(df: DataFrame, listed: str) -> DataFrame:
    return df.where(F.size(listed) != F.size(F.array_distinct(listed)))


def years_out_of_range(df: DataFrame, listed: str, start: int, end: int) -> DataFrame:
    return df.where(F.exists(listed, lambda k: (k < start) | (k > end)))
