"""The three jobs: preprocess (find and constrain outliers), adjust, map.

Each job is a function from DataFrames to DataFrames; writing is a separate
step (:mod:`panel_edit.sources.csv`). A job writes its working panel once, as
Parquet under the session's shared checkpoint folder, where several outputs,
statistics or checks read it: each reads the columns that it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panel_edit.operators import change, checks, constrain, outliers, reshape
from panel_edit.operators.groups import id_violations
from panel_edit.session import columnar
from panel_edit.sources.qa import parameters_frame

IDS = reshape.DEFAULT_IDS
#: The ratios that get z-scores.
SCORED = {"bkwd": "backward_pct_change", "frwd": "forward_pct_change"}


def _check_ids(areas: DataFrame, parent: str, area: str, ids: Sequence[str]) -> None:
    """Area rows need their codes and must be unique: the wide pivots would be ambiguous."""
    missing, duplicates = id_violations(areas.select(*ids), parent, area, ids)
    if missing:
        raise checks.CheckFailed(f"{missing} rows without an area or parent code")
    if duplicates:
        raise checks.CheckFailed(f"{duplicates} duplicate area rows: the wide pivots would be ambiguous")


@dataclass
class PreprocessResult:
    output: DataFrame
    interim: DataFrame
    parameters: DataFrame


def preprocess(
    panel_wide: DataFrame,
    totals_wide: DataFrame,
    *,
    start: int,
    end: int,
    rollback_start: int,
    rollback_end: int,
    transaction: str,
    zscore: bool = True,
    iqr: bool = True,
    z_upper: float = 3.0,
    z_lower: float = -3.0,
    iqr_lower_quantile: float = 0.25,
    iqr_upper_quantile: float = 0.75,
    iqr_multiplier: float = 3.0,
    ids: Sequence[str] = IDS,
    check: bool = True,
    transaction_col: str = "transaction",
    total_descriptors: Sequence[str] = constrain.TOTAL_DESCRIPTORS,
) -> PreprocessResult:
    """Stage 1: flag outlier areas and constrain them (and their parent mean) to parent totals.

    ``panel_wide``: ids + one column per period of unconstrained values.
    ``totals_wide``: parent totals, ids (parent, transaction, descriptors) +
    one column per period. The output has two rows per outlier area: its
    values ("TRUE") and the non-outlier mean of its parent ("MEAN"), each
    with ``CONLSOA_<period>`` constrained columns.
    """
    area, parent = ids[0], ids[2]
    if check:
        _check_ids(panel_wide, parent, area, ids)
    long = reshape.wide_to_long(panel_wide, "period", "uncon", periods=(start, end))
    long = long.where(F.col("period").between(start, end))
    # Only the job's periods can meet the panel: other period columns are never read.
    totals = reshape.wide_to_long(totals_wide, "period", "uncon", periods=(start, end))
    if check:
        # Two totals for one parent and period would duplicate outlier rows (ambiguous pivot).
        one = constrain.transaction_totals(totals, transaction, transaction_col, total_descriptors)
        checks.require(checks.duplicate_keys(one, [parent, "period"]), "duplicate parent totals for one period")

    df = change.rate_of_change(long, area=area)
    # The statistics below read the ratios, not the windows that made them.
    df = columnar(change.flag_rollback_years(df, rollback_start, rollback_end), "preprocess-panel")
    if zscore:
        df = outliers.zscores_of(df, SCORED, parent, z_upper, z_lower)
    if iqr:
        df = outliers.iqr_fences(
            df, "raw", [parent, "period"], "uncon", iqr_lower_quantile, iqr_upper_quantile, iqr_multiplier)
    df = outliers.master_flag(df, zscore, iqr, area=area)
    interim = columnar(df, "preprocess-interim")

    keep = [*ids, "period", "uncon", *[c for c in interim.columns if c.startswith("master_")]]
    flagged = constrain.parent_mean(interim.select(*keep), parent=parent)
    flagged = constrain.constrain_to_parent_totals(flagged, totals, transaction, transaction_col=transaction_col,
                                                   drop_cols=total_descriptors, parent=parent)

    periods = reshape.periods_within(panel_wide, start, end)
    pairs = {"TRUE": ("uncon", "con_area"), "MEAN": ("mean_non_outlier", "con_mean")}
    output = constrain.sorted_rows(reshape.metric_pairs_wide(flagged, periods, pairs, ids=ids), area=area)

    params = parameters_frame(
        panel_wide.sparkSession,
        {  # fixed values: the parameter names of the file format
            "zscore_lower_threshold": z_lower,
            "zscore_upper_threshold": z_upper,
            "iqr_lower_quantile": iqr_lower_quantile,
            "iqr_upper_quantile": iqr_upper_quantile,
            "iqr_multiplier": iqr_multiplier,
            "transaction_name": transaction,
        },
    )
    return PreprocessResult(output=output, interim=interim, parameters=params)


@dataclass
class AdjustResult:
    output: DataFrame
    interim: DataFrame
    parameters: DataFrame


def adjust(
    decisions: DataFrame,
    con_wide: DataFrame,
    uncon_wide: DataFrame,
    *,
    start: int,
    end: int,
    rollback_start: int,
    rollback_end: int,
    accept_negatives: bool = False,
    final_value: str = "readjusted",
    ids: Sequence[str] = IDS,
    component_filters: dict | None = None,
    check: bool = True,
) -> AdjustResult:
    """Stage 2: impute the listed area-periods and re-apportion within each parent and period.

    ``decisions``: ids + ``adjust`` text + ``year`` text (the analyst's list).
    ``con_wide`` / ``uncon_wide``: ids + one column per period.
    ``final_value``: "readjusted" (parity: negatives removed when not
    accepted) or "rollback" (copied-back periods re-shared, too).
    """
    from panel_edit.operators import apportion, decisions as dec, filters, impute

    area, parent = ids[0], ids[2]
    if check:
        _check_ids(uncon_wide, parent, area, ids)
    d = dec.year_list(dec.adjust_flag(decisions))
    if check:
        dec.check_year_lists(d, start, end)
    d = dec.filter_adjust(d, area=area, parent=parent)
    j1 = dec.join_decisions_con(con_wide, d, keys=(area, parent), keep_names=(*ids, "adjust", "year"), check=False)
    j = dec.join_decisions_uncon(uncon_wide, j1, keys=ids, check=False)
    if check:
        dec.check_joins([(con_wide, d, (area, parent), "constrained"), (uncon_wide, j1, ids, "unconstrained")])
    long = reshape.adjust_long(j, ids=ids)
    long = filters.filter_period(long, start, end)

    long = change.rate_of_change(long, area=area)
    long = change.flag_rollback_years(long, rollback_start, rollback_end)
    long = columnar(long, "adjust-panel")
    # Rollback flags are final here: the scalar reads the materialised panel.
    latest = apportion.latest_rollback_period(long)
    panel, imputed = impute.safe_years(long, start, end, area=area)
    imputed = impute.interpolate(imputed)
    imputed = impute.extrapolate(panel, imputed, area=area)
    imputed = imputed.select(area, "period", "imputed")  # read once, from the materialised panel

    # Checks of the four steps run once, below, on the materialised result.
    df = apportion.share_out(panel, imputed, area=area, parent=parent)
    df = columnar(df, "adjust-shared")  # the next steps' statistics read what was shared out
    value = "adjusted_con"
    if not accept_negatives:
        df = apportion.remove_negatives(df, parent=parent, check=False)
        value = "readjusted_con"
    df = apportion.rollback_years(df, area=area, parent=parent, value=value, check=False, latest=latest)
    interim = columnar(df, "adjust-interim")
    if check:
        apportion.check_apportioned(interim, parent=parent)

    chosen = "rollback_con" if final_value == "rollback" else value
    # Unique area rows (checked above) and a join that adds no rows make (ids, period) unique.
    final = interim.select(*ids, "period", F.col(chosen).alias("con"))
    output = reshape.final_wide(final, reshape.periods_within(uncon_wide, start, end), "con", ids)

    # The parameter names of the file format.
    filters_used = component_filters or {"sas_code_filter": None, "cord_code_filter": None,
                                         "credit_debit_filter": None}
    params = parameters_frame(decisions.sparkSession, filters_used)
    return AdjustResult(output=output, interim=interim, parameters=params)


@dataclass
class MappingResult:
    need_mapping: bool
    output: DataFrame | None
    unmatched: DataFrame | None
    ambiguous: DataFrame | None = None


def map_geography(
    adjusted_wide: DataFrame,
    mapper: DataFrame,
    *,
    aggregate: bool = False,
    keys: Sequence[str] | None = None,
    code_col: str = "parent",
    name_col: str = "parent_name",
    prefix: str = "S30",
) -> MappingResult:
    """Stage 3: when unit codes (``prefix``) are present, map parents to the lookup's geography.

    ``aggregate`` sums the year columns by the mapped geography (by every
    other column too unless ``keys`` is given). Rows the lookup does not
    cover are returned as ``unmatched``.
    """
    from panel_edit.operators import mapping

    original = adjusted_wide.columns
    df, need = mapping.prefix_rename(adjusted_wide, code_col, name_col, prefix)
    if not need:
        return MappingResult(False, None, None)
    clean, _ = mapping.clean_mapper(mapper)
    joined = mapping.join_mapper(df, clean)
    result = mapping.aggregate(joined, keys) if aggregate else joined
    return MappingResult(True, mapping.reformat(result, original, code_col, name_col), mapping.unmatched(joined),
                         mapping.ambiguous_units(clean))
