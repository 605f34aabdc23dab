"""Re-apportioning within each parent and period so that parent totals are preserved.

Every per-group quantity (totals, minima, sums of imputations) goes through
:func:`panel_edit.operators.groups.attach_group_stats`: a partial aggregation
per (parent, period) joined back, so a parent holding a third of all rows is
combined map-side instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panel_edit.functions.columns import is_true
from panel_edit.functions.lists import contains_period
from panel_edit.operators import checks
from panel_edit.operators.groups import attach_group_stats
from panel_edit.operators.sums import exact_sum

#: Absolute and relative tolerance of the parent-total checks.
SUM_TOLERANCE = 1e-6
RELATIVE_TOLERANCE = 1e-12


def proportions(
    df: DataFrame,
    parent: str = "parent",
    period: str = "period",
    value: str = "con",
    listed: str = "year_to_adjust",
    check: bool = True,
) -> DataFrame:
    """Add ``parent_total``, ``non_outlier_total`` (unlisted rows only) and ``proportion``.

    ``proportion = value / non_outlier_total`` for unlisted rows, NULL for
    listed ones. A zero non-outlier total is an error listing the groups.
    """
    out = attach_group_stats(df.withColumn("_listed", contains_period(listed, period)), [parent, period], _total_stats(value))
    out = _with_proportion(out, value)
    if check:
        zeros = checks.zero_totals(out, [parent, period], "non_outlier_total").orderBy(parent, period)
        checks.require(zeros, "Non-outlier total check failed: found zero non_outlier_total for groups")
    return out


def _total_stats(value: str) -> dict:
    return {"parent_total": exact_sum(value), "_non_outlier": exact_sum(F.when(~F.col("_listed"), F.col(value)))}


def _with_proportion(df: DataFrame, value: str) -> DataFrame:
    return (
        df.withColumn("parent_total", F.coalesce("parent_total", F.lit(0.0)))
        .withColumn("non_outlier_total", F.when(~F.col("_listed"), F.coalesce("_non_outlier", F.lit(0.0))))
        .drop("_non_outlier", "_listed")
        .withColumn("proportion", F.try_divide(F.col(value), F.col("non_outlier_total")))
    )


def apportion(
    df: DataFrame,
    imputed: DataFrame,
    area: str = "area",
    parent: str = "parent",
    period: str = "period",
    value: str = "con",
    imputed_col: str = "imputed",
    out: str = "adjusted_con",
    check: bool = True,
    tolerance: float = SUM_TOLERANCE,
    relative: float = RELATIVE_TOLERANCE,
) -> DataFrame:
    """Imputed values replace listed rows; the rest of the parent total is shared by proportion.

    ``adjusted_total = parent_total - sum(imputed)`` per (parent, period);
    ``out = imputed`` where present, else ``proportion * adjusted_total``.
    """
    x = df.join(imputed.select(area, period, imputed_col), [area, period], "left")
    x = attach_group_stats(x, [parent, period], {"_imputed_sum": exact_sum(imputed_col)})
    x = _with_adjusted(x, imputed_col, out)
    if check:
        checks.require(
            checks.sum_mismatches(x, [parent, period], value, out, tolerance, relative),
            "Adjustment check failed: parent sums do not match after adjustment",
        )
    return x


def _with_adjusted(df: DataFrame, imputed_col: str, out: str) -> DataFrame:
    return (
        df.withColumn("adjusted_total", F.col("parent_total") - F.coalesce("_imputed_sum", F.lit(0.0)))
        .drop("_imputed_sum")
        .withColumn(out, F.when(F.col(imputed_col).isNotNull(), F.col(imputed_col)).otherwise(
            F.col("proportion") * F.col("adjusted_total")))
    )


def share_out(
    df: DataFrame,
    imputed: DataFrame,
    area: str = "area",
    parent: str = "parent",
    period: str = "period",
    value: str = "con",
    listed: str = "year_to_adjust",
    imputed_col: str = "imputed",
    out: str = "adjusted_con",
) -> DataFrame:
    """:func:`proportions` and :func:`apportion` with every statistic from one aggregate; :func:`check_apportioned` checks both."""
    x = df.join(imputed.select(area, period, imputed_col), [area, period], "left").withColumn("_listed", contains_period(listed, period))
    x = attach_group_stats(x, [parent, period], {**_total_stats(value), "_imputed_sum": exact_sum(imputed_col)})
    return _with_adjusted(_with_proportion(x, value), imputed_col, out)


def remove_negatives(
    df: DataFrame,
    parent: str = "parent",
    period: str = "period",
    value: str = "con",
    adjusted: str = "adjusted_con",
    total: str = "parent_total",
    out: str = "readjusted_con",
    check: bool = True,
    tolerance: float = SUM_TOLERANCE,
    relative: float = RELATIVE_TOLERANCE,
) -> DataFrame:
    """Shift a (parent, period) group up by |its minimum| if negative, then rescale to the parent total.

    ``over = adjusted + shift``; ``out = over / sum(over) * total``. The group
    sum of ``over`` is ``sum(adjusted) + n * shift`` (n = non-missing values),
    so one partial aggregation gives every statistic.
    """
    x = attach_group_stats(
        df,
        [parent, period],
        {"min_adjusted": F.min(adjusted), "_adj_sum": exact_sum(adjusted), "_adj_n": F.count(adjusted)},
    )
    shift = F.when(F.col("min_adjusted") < 0, F.abs(F.col("min_adjusted"))).otherwise(F.lit(0.0))
    x = (
        x.withColumn("abs_adjustment", shift)
        .withColumn("over_adjusted", F.col(adjusted) + F.col("abs_adjustment"))
        .withColumn("_over_sum", F.col("_adj_sum") + F.col("_adj_n") * F.col("abs_adjustment"))
        .withColumn(out, F.try_divide(F.col("over_adjusted"), F.col("_over_sum")) * F.col(total))
        .drop("_adj_sum", "_adj_n", "_over_sum")
    )
    if check:
        checks.require(checks.negatives(x, out).select(parent, period, out),
                       "Negative value check failed: negative values found after adjustment")
        checks.require(
            checks.sum_mismatches(x, [parent, period], value, out, tolerance, relative),
            "Adjustment check failed: parent sums do not match after adjustment",
        )
    return x


def check_apportioned(
    df: DataFrame,
    parent: str = "parent",
    period: str = "period",
    source: str = "con",
    adjusted: tuple[str, ...] = ("adjusted_con", "readjusted_con", "rollback_con"),
    tolerance: float = SUM_TOLERANCE,
    relative: float = RELATIVE_TOLERANCE,
) -> None:
    """All checks of the apportioning steps in one aggregate job over a materialised frame.

    Raises in the order the steps would: zero non-outlier total, then for
    each adjusted column present a negative value (re-adjusted only) and a
    parent-period total that moved.
    """
    present = [c for c in adjusted if c in df.columns]
    aggs = [F.coalesce(exact_sum(source), F.lit(0.0)).alias("_before")]
    if "non_outlier_total" in df.columns:
        aggs.append(F.max((F.col("non_outlier_total") == 0).cast("int")).alias("_zero"))
    for i, c in enumerate(present):
        aggs.append(F.coalesce(exact_sum(c), F.lit(0.0)).alias(f"_after{i}"))
        aggs.append(F.min(c).alias(f"_min{i}"))
    groups = df.groupBy(parent, period).agg(*aggs)
    allowed = F.lit(tolerance) + F.lit(relative) * F.abs(F.col("_before"))
    bad, names = [], []
    if "non_outlier_total" in df.columns:
        bad.append(F.coalesce(F.col("_zero") == 1, F.lit(False)))
        names.append("the total to share by is zero (zero non_outlier_total)")
    for i, c in enumerate(present):
        if c == "readjusted_con":
            bad.append(F.coalesce(F.col(f"_min{i}") < 0, F.lit(False)))
            names.append(f"negative values are left in {c}")
        bad.append(~F.coalesce(F.abs(F.col("_before") - F.col(f"_after{i}")) <= allowed, F.lit(False)))
        names.append(f"parent sums do not match: {source} and {c}")
    # One flag per violation class, in step order, from one aggregate over the groups.
    found = groups.agg(*[F.sum(b.cast("long")).alias(f"_bad{k}") for k, b in enumerate(bad)]).first()
    for k, (name, b) in enumerate(zip(names, bad)):
        total = found[f"_bad{k}"] or 0
        if total:
            sample = [tuple(r) for r in groups.where(b).select(parent, period).orderBy(parent, period).take(checks.SHOWN)]
            raise checks.CheckFailed(f"{name} in {total} (parent, period) groups; first {len(sample)}: {sample}")


def latest_rollback_period(df: DataFrame, period: str = "period", rollback: str = "rollback_flag") -> Column:
    """Latest period of any rollback row, as a scalar subquery (NULL without rollback rows): planned with its query, no round trip."""
    return df.where(is_true(rollback)).agg(F.max(period)).scalar()


def rollback_years(
    df: DataFrame,
    area: str = "area",
    parent: str = "parent",
    period: str = "period",
    value: str = "readjusted_con",
    source: str = "con",
    total: str = "parent_total",
    rollback: str = "rollback_flag",
    out: str = "rollback_con",
    check: bool = True,
    tolerance: float = SUM_TOLERANCE,
    relative: float = RELATIVE_TOLERANCE,
    latest: Column | None = None,
) -> DataFrame:
    """Share copied-back periods like the last copied-back period.

    ``m`` = latest period of any rollback row (a scalar subquery). Rollback rows
    get ``total * (area's value in m) / (parent's sum in m)``; others keep
    ``value``, and so do all without any rollback row. The area's value comes
    from a window over the area (one row per period); the parent's sum from
    :func:`attach_group_stats`.
    """
    if latest is None:
        latest = latest_rollback_period(df, period, rollback)
    x = df.withColumn("_at_m", F.coalesce(F.col(period) == latest, F.lit(False)))
    x = x.withColumn("_area_m", F.min(F.when(F.col("_at_m"), F.col(value))).over(Window.partitionBy(area)))
    x = attach_group_stats(x, [parent], {"_parent_m": exact_sum(F.when(F.col("_at_m"), F.col(value)))})
    share = F.col(total) * F.try_divide(F.col("_area_m"), F.col("_parent_m"))
    x = x.withColumn(out, F.when(is_true(rollback), share).otherwise(F.col(value))).drop("_at_m", "_area_m", "_parent_m")
    if check:
        checks.require(
            checks.sum_mismatches(x, [parent, period], source, out, tolerance, relative),
            "Adjustment check failed: parent sums do not match after adjustment",
        )
    return x
