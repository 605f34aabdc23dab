"""Outlier detection: grouped z-scores, IQR fences, and the per-area master flag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panel_edit.functions.columns import is_true, nan_to_null
from panel_edit.operators.groups import attach_group_stats
from panel_edit.operators.quantiles import group_quantiles


def _keys(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def _threshold(value, upper, lower):
    return F.when(value > upper, F.lit("upper")).when(value < lower, F.lit("lower"))


def zscores(
    df: DataFrame,
    prefix: str,
    group: str | Sequence[str] = "parent",
    value: str = "backward_pct_change",
    upper: float = 3.0,
    lower: float = -3.0,
    rollback_col: str = "rollback_flag",
) -> DataFrame:
    """Add ``{prefix}_zscore``, ``{prefix}_zscore_threshold`` and ``z_{prefix}_flag``.

    The score is ``(x - mean) / sample std`` over the group's non-rollback,
    non-missing values; rollback rows and missing values get no score, nor
    does a group whose standard deviation is 0 or undefined. Mean and standard
    deviation come from :func:`attach_group_stats`.
    """
    return zscores_of(df, {prefix: value}, group, upper, lower, rollback_col)


def zscores_of(
    df: DataFrame,
    values: Mapping[str, str],
    group: str | Sequence[str] = "parent",
    upper: float = 3.0,
    lower: float = -3.0,
    rollback_col: str = "rollback_flag",
) -> DataFrame:
    """:func:`zscores` for each ``prefix -> value column``, with all statistics from one aggregate."""
    x = {p: F.when(~is_true(rollback_col), nan_to_null(v)) for p, v in values.items()}
    stats = {f"_mean_{p}": F.avg(c) for p, c in x.items()} | {f"_std_{p}": F.stddev_samp(c) for p, c in x.items()}
    out = attach_group_stats(df, _keys(group), stats)
    for p, c in x.items():
        z = nan_to_null(F.try_divide(c - F.col(f"_mean_{p}"), F.nullif(F.col(f"_std_{p}"), F.lit(0.0))))
        score = f"{p}_zscore"
        out = out.withColumn(score, z).withColumns(
            {f"{p}_zscore_threshold": _threshold(F.col(score), upper, lower),
             f"z_{p}_flag": is_true((F.col(score) > upper) | (F.col(score) < lower))})
    return out.drop(*stats)


def iqr_fences(
    df: DataFrame,
    prefix: str,
    group: str | Sequence[str] = ("parent", "period"),
    value: str = "uncon",
    lower_quantile: float = 0.25,
    upper_quantile: float = 0.75,
    multiplier: float = 3.0,
    rollback_col: str = "rollback_flag",
) -> DataFrame:
    """Add quartiles, IQR, fences, ``{prefix}_iqr_threshold`` and ``iqr_{prefix}_flag``.

    Quartiles use non-rollback rows only; every row (rollback rows too) is
    tested against the fences with strict ``<`` / ``>``.
    """
    keys = _keys(group)
    q1, q3 = f"{prefix}_q1", f"{prefix}_q3"
    xv = F.when(~is_true(rollback_col), nan_to_null(value))
    x = df.select(*keys, xv.alias("_iqr_x"))
    quartiles = group_quantiles(x, keys, "_iqr_x", {q1: lower_quantile, q3: upper_quantile})
    out = df.join(quartiles, on=keys, how="left")
    iqr, lo, hi = f"{prefix}_iqr", f"{prefix}_lower_bound", f"{prefix}_upper_bound"
    v = nan_to_null(value)
    return (
        out.withColumn(iqr, F.col(q3) - F.col(q1))
        .withColumns({lo: F.col(q1) - F.lit(multiplier) * F.col(iqr), hi: F.col(q3) + F.lit(multiplier) * F.col(iqr)})
        .withColumns({f"{prefix}_iqr_threshold": _threshold(v, F.col(hi), F.col(lo)),
                      f"iqr_{prefix}_flag": is_true((v > F.col(hi)) | (v < F.col(lo)))})
    )


def master_flag(
    df: DataFrame,
    zscore: bool = True,
    iqr: bool = True,
    area: str = "area",
    flag_col: str = "master_flag",
) -> DataFrame:
    """Flag whole areas.

    ``master_z_flag``: any ``z_*`` column is true in any period of the area;
    ``master_iqr_flag`` likewise for ``iqr_*``. ``flag_col`` is the AND of
    every ``master_*`` column. The per-area "any" is a window over one area
    (at most one row per period), which reuses the area partitioning of the
    rate-of-change step.
    """
    if not (zscore or iqr):
        raise ValueError(
            "master_flag needs at least one detector: with none, every area would be flagged"
        )
    w = Window.partitionBy(area)
    out = df
    for enabled, prefix, name in ((zscore, "z_", "master_z_flag"), (iqr, "iqr_", "master_iqr_flag")):
        if not enabled:
            continue
        cols = [c for c in out.columns if c.startswith(prefix)]
        any_row = reduce(lambda a, b: a | b, [is_true(F.col(c).cast("boolean")) for c in cols], F.lit(False))
        out = out.withColumn(name, F.max(any_row).over(w))
    masters = [c for c in out.columns if c.startswith("master_") and c != flag_col]
    combined = reduce(lambda a, b: a & b, [is_true(F.col(c)) for c in masters], F.lit(True))
    return out.withColumn(flag_col, combined)
