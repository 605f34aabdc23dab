"""Constraining outlier areas to trusted parent totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from panel_edit.functions.columns import is_true, nan_to_null

#: Descriptor columns of the parent-total table dropped before the join.
TOTAL_DESCRIPTORS = ("region", "region_name", "transaction_code", "transaction")


def parent_mean(
    df: DataFrame,
    flag: str = "master_flag",
    parent: str = "parent",
    period: str = "period",
    value: str = "uncon",
    mean_col: str = "mean_non_outlier",
) -> DataFrame:
    """Flagged rows only, with the mean ``value`` of the *unflagged* areas of their parent and period.

    The mean is computed over all rows before the flagged rows are kept.
    """
    means = df.where(~is_true(flag)).groupBy(parent, period).agg(F.avg(nan_to_null(value)).alias(mean_col))
    return df.where(is_true(flag)).join(means, [parent, period], "left")


def thousands_to_double(c: str, dtype) -> F.Column:
    """Text with thousands separators ("1,234.5") -> double; numbers pass through."""
    if isinstance(dtype, StringType):
        return F.regexp_replace(F.col(c), ",", "").cast("double")
    return F.col(c).cast("double")


def transaction_totals(
    totals: DataFrame,
    transaction: str,
    transaction_col: str = "transaction",
    drop_cols: Sequence[str] = TOTAL_DESCRIPTORS,
) -> DataFrame:
    """Rows of one transaction, descriptor columns dropped."""
    return totals.where(F.col(transaction_col) == transaction).drop(*drop_cols)


def constrain_to_parent_totals(
    df: DataFrame,
    totals: DataFrame,
    transaction: str,
    transaction_col: str = "transaction",
    drop_cols: Sequence[str] = TOTAL_DESCRIPTORS,
    parent: str = "parent",
    period: str = "period",
    value: str = "uncon",
    mean_col: str = "mean_non_outlier",
    flag: str = "master_flag",
    con_col: str = "con_area",
    con_mean_col: str = "con_mean",
) -> DataFrame:
    """Scale each outlier value and its parent mean so that together they meet the parent total.

    ``totals`` is long: ``parent, period, <value>`` plus descriptor columns,
    values possibly text with thousands separators. ``rate = total /
    (value + mean)`` (0 when the denominator is 0); ``con_col = value *
    rate``; ``con_mean_col = mean * rate``; the flag becomes "TRUE"/"MEAN".
    """
    t = transaction_totals(totals, transaction, transaction_col, drop_cols)
    missing = [c for c in t.columns if c not in df.columns]
    if missing:
        raise ValueError(f"parent totals have columns the panel lacks: {missing}")
    dtype = t.schema[value].dataType
    t = t.select(parent, period, thousands_to_double(value, dtype).alias("_parent_total"))
    out = df.join(t, [parent, period], "left")
    denominator = F.col(value) + F.col(mean_col)
    rate = F.when(denominator == 0, F.lit(0.0)).otherwise(F.try_divide(F.col("_parent_total"), denominator))
    return (
        out.withColumn("_rate", rate)
        .withColumn(con_col, F.col(value) * F.col("_rate"))
        .withColumn(con_mean_col, F.col(mean_col) * F.col("_rate"))
        .withColumn(flag, F.when(is_true(flag), F.lit("TRUE")).otherwise(F.lit("MEAN")))
        .drop("_parent_total", "_rate")
    )


def union_sorted(outliers: DataFrame, means: DataFrame, area: str = "area", flag: str = "master_flag") -> DataFrame:
    """Union by name (missing columns NULL), ordered by area, then "TRUE" rows before "MEAN"."""
    return sorted_rows(outliers.unionByName(means, allowMissingColumns=True), area, flag)


def sorted_rows(rows: DataFrame, area: str = "area", flag: str = "master_flag") -> DataFrame:
    """Ordered by area, then "TRUE" rows before "MEAN"."""
    return rows.orderBy(F.col(area).asc(), F.col(flag).desc())
