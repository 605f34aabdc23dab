"""Period-on-period ratios per area and the copied-back ("rollback") flag.

Both ratios use one window ``partitionBy(area).orderBy(period)``, so Catalyst
plans a single exchange and a single sort for them. A window over one area
holds at most one row per period (areas are unique per period), so no hot
key can overload a task here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panel_edit.functions.columns import is_true, nan_to_null


def _divide(num: Column, den: Column, zero_base: str) -> Column:
    if zero_base == "null":
        return F.try_divide(num, den)
    if zero_base == "inf":
        # x/0 -> +-inf, 0/0 -> NaN, as floating-point division gives.
        signed = F.when(num > 0, F.lit(float("inf"))).when(num < 0, F.lit(float("-inf")))
        return F.when(den == 0, signed.otherwise(F.lit(float("nan")))).otherwise(num / den)
    raise ValueError(f"zero_base must be 'null' or 'inf', got {zero_base!r}")


def rate_of_change(
    df: DataFrame,
    area: str = "area",
    period: str = "period",
    value: str = "uncon",
    forward_col: str = "forward_pct_change",
    backward_col: str = "backward_pct_change",
    zero_base: str = "null",
) -> DataFrame:
    """Add ``forward_col = v/previous`` and ``backward_col = v/next`` per area.

    Neighbours are the adjacent *rows* in period order. A missing value is
    first filled from the nearest earlier row (forward ratio) or nearest
    later row (backward ratio), so a gap row gets ratio 1.0, and the ratio is
    computed as ``(v/neighbour - 1) + 1`` like a percentage change plus one.
    ``zero_base``: ``"null"`` (default) gives NULL for a zero neighbour,
    ``"inf"`` gives +-inf / NaN as plain floating-point division would.
    """
    w = Window.partitionBy(area).orderBy(period)
    v = nan_to_null(value)
    filled_up = F.last(v, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    filled_down = F.first(v, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    out = df.withColumn("_fill_up", filled_up).withColumn("_fill_down", filled_down)
    fwd = _divide(F.col("_fill_up"), F.lag("_fill_up").over(w), zero_base) - 1.0 + 1.0
    bwd = _divide(F.col("_fill_down"), F.lead("_fill_down").over(w), zero_base) - 1.0 + 1.0
    return out.withColumn(backward_col, bwd).withColumn(forward_col, fwd).drop("_fill_up", "_fill_down")


def flag_rollback_years(
    df: DataFrame,
    start: int,
    end: int,
    period: str = "period",
    forward_col: str = "forward_pct_change",
    backward_col: str = "backward_pct_change",
    flag_col: str = "rollback_flag",
) -> DataFrame:
    """``flag_col`` = a ratio equals exactly 1.0 and ``start <= period <= end``."""
    unchanged = is_true((F.col(backward_col) == 1.0) | (F.col(forward_col) == 1.0))
    return df.withColumn(flag_col, unchanged & is_true(F.col(period).between(start, end)))
