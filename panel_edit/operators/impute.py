"""Imputation of the analyst's listed area-periods from safe (unlisted) periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panel_edit.functions.columns import is_true
from panel_edit.functions.lists import contains_period, ensure_list, next_free_year, previous_free_year

#: Periods between a safe period and the extra point used for extrapolation (fixed value).
EXTRAPOLATION_GAP = 4
SERIES = "con_by_period"


def safe_years(
    df: DataFrame,
    start: int = 1900,
    end: int = 2100,
    area: str = "area",
    period: str = "period",
    listed: str = "year_to_adjust",
    value: str = "con",
) -> tuple[DataFrame, DataFrame]:
    """Return ``(df, imputed)``: the panel with NULL lists made empty, and its listed rows.

    For each listed row: the nearest earlier / later period that is not
    listed (never beyond ``start - 1`` / ``end + 1``) and the area's value
    there (NULL when that period has no row). The area's values are read
    from a map built by a window over the area - at most one entry per
    period - which reuses the area partitioning of earlier steps; the map is
    kept in ``con_by_period`` for :func:`extrapolate` and dropped there.
    """
    df = df.withColumn(listed, ensure_list(listed))
    series = F.map_from_entries(F.collect_list(F.struct(F.col(period), F.col(value))).over(Window.partitionBy(area)))
    imputed = (
        # The list is the area's: areas without one need no series.
        df.where(F.size(listed) > 0).withColumn(SERIES, series)
        .where(contains_period(listed, period))
        .withColumns({"prev_safe_year": previous_free_year(period, listed, start),
                      "next_safe_year": next_free_year(period, listed, end)})
        .withColumns({"prev_con": F.try_element_at(SERIES, F.col("prev_safe_year")),
                      "next_con": F.try_element_at(SERIES, F.col("next_safe_year"))})
    )
    return df, imputed


def interpolate(df: DataFrame, period: str = "period", rollback: str = "rollback_flag",
                out: str = "imputed") -> DataFrame:
    """Linear value between the two safe periods when both are known and the row is not a rollback row."""
    p, n = F.col("prev_con"), F.col("next_con")
    py, ny = F.col("prev_safe_year"), F.col("next_safe_year")
    line = F.try_divide(n - p, ny - py) * (F.col(period) - py) + p
    return df.withColumn(out, F.when(p.isNotNull() & n.isNotNull() & ~is_true(rollback), line))


def extrapolate(
    panel: DataFrame,
    imputed: DataFrame,
    area: str = "area",
    period: str = "period",
    value: str = "con",
    rollback: str = "rollback_flag",
    out: str = "imputed",
    gap: int = EXTRAPOLATION_GAP,
) -> DataFrame:
    """Fill still-missing imputations on the line through a safe period and one ``gap`` periods beyond it.

    Extra period: ``next + gap`` when the earlier neighbour is missing or the
    row is a rollback row, else ``prev - gap`` when the later neighbour is
    missing. The extra period is not itself checked for being safe.
    """
    p, n = F.col("prev_con"), F.col("next_con")
    py, ny = F.col("prev_safe_year"), F.col("next_safe_year")
    from_next = p.isNull() | is_true(rollback)
    extra_year = F.when(from_next, ny + gap).when(n.isNull(), py - gap)
    x = imputed.withColumn("_extra_year", extra_year)
    if SERIES in x.columns:
        x = x.withColumn("_extra_con", F.try_element_at(SERIES, F.col("_extra_year")))
    else:
        wanted = x.select(F.col(area), F.col("_extra_year").alias(period)).where(F.col(period).isNotNull()).distinct()
        found = panel.select(area, period, F.col(value).alias("_extra_con")).join(wanted, [area, period])
        x = x.join(found.withColumnRenamed(period, "_extra_year"), [area, "_extra_year"], "left")
    ey, ev = F.col("_extra_year"), F.col("_extra_con")
    forward = n - F.try_divide(ev - n, ey - ny) * (ny - F.col(period))
    backward = p + F.try_divide(p - ev, py - ey) * (F.col(period) - py)
    filled = F.when(F.col(out).isNull() & ev.isNotNull(), F.when(from_next, forward).otherwise(backward)).otherwise(F.col(out))
    return x.withColumn(out, filled).drop("_extra_year", "_extra_con", SERIES)
