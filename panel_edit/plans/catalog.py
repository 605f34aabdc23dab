"""Registered queries: one per operator of the inventory, plus the three jobs.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
derived panel. Floating results are rounded (ratios and scores to 6 places,
money to 4) so that the DuckDB twins in :mod:`panel_edit.plans.oracle_sql`
hash equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import DoubleType

from panel_edit.functions.lists import next_free_year, parse_year_list, previous_free_year
from panel_edit.operators import (
    apportion, change, checks, constrain, decisions, filters, impute, mapping, outliers, reshape,
)
from panel_edit.operators.groups import attach_group_stats
from panel_edit.operators.sums import exact_sum
from panel_edit.session import cut_lineage, remove_path, scratch_path
from panel_edit.sources import csv
from panel_edit.sources.tables import table
from panel_edit.plans import fixtures as fx
from panel_edit.plans import jobs

#: Parameters of the registered queries (fixed values, not from the reference).
Z_UPPER, Z_LOWER = 2.0, -2.0
IQR_LOWER, IQR_UPPER, IQR_MULTIPLIER = 0.25, 0.75, 1.0
TRANSACTION = fx.TRANSACTIONS[0]
IDS = list(reshape.DEFAULT_IDS)


def scaled_round(c, digits: int):
    """``round(c * 10^d) / 10^d + 0.0``: the same IEEE steps as the SQL twin's rounding.

    Rounding the scaled double to an integer (half away from zero) and scaling
    back gives bit-identical results in both engines, also for large values
    where ``x * 10^d`` itself is rounded; ``+ 0.0`` turns -0.0 into 0.0.
    """
    k = F.lit(10.0 ** digits)
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * k) / k + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 4, **overrides: int) -> DataFrame:
    """Round every double column (so that both engines hash equal).

    Means of integer values are exact ``S/n`` in both engines and are kept to
    6 places, where a rounding tie would need 128 or more values.
    """
    def one(f):
        if not isinstance(f.dataType, DoubleType):
            return F.col(f"`{f.name}`")
        return scaled_round(F.col(f"`{f.name}`"), overrides.get(f.name, digits)).alias(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


# ---- stage 1: preprocessing ----------------------------------------------------------------

def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.panel(spark, sf_dir)
    r = change.rate_of_change(p)
    return change.flag_rollback_years(r, fx.ROLLBACK_START, fx.ROLLBACK_END)


def with_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = ratios(spark, sf_dir)
    return outliers.zscores_of(r, jobs.SCORED, "parent", Z_UPPER, Z_LOWER)


def iqr(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.iqr_fences(df, "raw", ["parent", "period"], "uncon", IQR_LOWER, IQR_UPPER, IQR_MULTIPLIER)


def q_w1_forward(spark, sf_dir):
    return ratios(spark, sf_dir).select("area", "period", scaled_round("forward_pct_change", 6).alias("forward_pct_change"))


def q_w2_backward(spark, sf_dir):
    return ratios(spark, sf_dir).select("area", "period",
                                        scaled_round("backward_pct_change", 6).alias("backward_pct_change"))


def q_d1_rollback(spark, sf_dir):
    return ratios(spark, sf_dir).select("area", "parent", "period", "rollback_flag")


def q_w3_zscore(spark, sf_dir):
    z = with_zscores(spark, sf_dir)
    return z.select(
        "area", "parent", "period",
        scaled_round("bkwd_zscore", 6).alias("bkwd_zscore"), "bkwd_zscore_threshold", "z_bkwd_flag",
        scaled_round("frwd_zscore", 6).alias("frwd_zscore"), "frwd_zscore_threshold", "z_frwd_flag",
    )


def with_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.master_flag(iqr(cut_lineage(with_zscores(spark, sf_dir)), spark, sf_dir))


def totals_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.wide_to_long(fx.parent_totals(spark, sf_dir), "period", "uncon")


def outlier_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = with_flags(spark, sf_dir)
    keep = [*IDS, "period", "uncon", *[c for c in f.columns if c.startswith("master_")]]
    return constrain.parent_mean(f.select(*keep))


def constrained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constrain.constrain_to_parent_totals(outlier_means(spark, sf_dir), totals_long(spark, sf_dir), TRANSACTION)


def q_d2_iqr(spark, sf_dir):
    r = iqr(ratios(spark, sf_dir), spark, sf_dir)
    return rounded(r.select("area", "parent", "period", "raw_q1", "raw_q3", "raw_iqr", "raw_lower_bound",
                            "raw_upper_bound", "raw_iqr_threshold", "iqr_raw_flag"))


def q_d3_master(spark, sf_dir):
    return with_flags(spark, sf_dir).select("area", "period", "master_z_flag", "master_iqr_flag", "master_flag")


def q_d4_parent_mean(spark, sf_dir):
    return rounded(outlier_means(spark, sf_dir).select("area", "parent", "period", "uncon", "mean_non_outlier"),
                   mean_non_outlier=6)


def q_d5_constrain(spark, sf_dir):
    return rounded(constrained(spark, sf_dir).select(
        "area", "parent", "period", "uncon", "mean_non_outlier", "con_area", "con_mean", "master_flag"))


def q_r1_wide_to_long(spark, sf_dir):
    w = fx.wide(spark, sf_dir, "uncon")
    return rounded(reshape.wide_to_long(w, "period", "uncon"))


def q_f4_transaction_filter(spark, sf_dir):
    return constrain.transaction_totals(totals_long(spark, sf_dir), TRANSACTION)


def q_v11_pivot_dups(spark, sf_dir):
    """Keys that make a period pivot ambiguous: parent totals keyed by parent alone (two transactions)."""
    return reshape.final_duplicates(totals_long(spark, sf_dir), ids=("parent",))


def q_p2_thousands(spark, sf_dir):
    t = totals_long(spark, sf_dir)
    return rounded(t.select("parent", "transaction", "period",
                            constrain.thousands_to_double("uncon", t.schema["uncon"].dataType).alias("value")), 2)


def q_r2_metrics_long(spark, sf_dir):
    c = constrained(spark, sf_dir).drop("mean_non_outlier", "con_mean")
    return rounded(reshape.metrics_long(c, "uncon", "con_area", ids=IDS))


def q_r3_metrics_wide(spark, sf_dir):
    c = constrained(spark, sf_dir).drop("mean_non_outlier", "con_mean")
    long = reshape.metrics_long(c, "uncon", "con_area", ids=IDS)
    return rounded(reshape.metrics_wide(long, fx.years(spark, sf_dir), ids=IDS))


def q_d6_union_sorted(spark, sf_dir):
    """The outliers' own wide rows and those of their parents' means, each pivoted on its own, in one sorted table."""
    c, years = constrained(spark, sf_dir), fx.years(spark, sf_dir)
    own = reshape.metrics_long(c.drop("mean_non_outlier", "con_mean"), "uncon", "con_area", ids=IDS)
    means = reshape.metrics_long(c.drop("uncon", "con_area").withColumn("master_flag", F.lit("MEAN")), "mean_non_outlier", "con_mean", ids=IDS)
    return rounded(constrain.union_sorted(*(reshape.metrics_wide(x, years, ids=IDS) for x in (own, means))))


def preprocess_job(spark: SparkSession, sf_dir: str) -> jobs.PreprocessResult:
    start, end = fx.span(spark, sf_dir)
    return jobs.preprocess(
        fx.wide(spark, sf_dir, "uncon"),
        fx.parent_totals(spark, sf_dir),
        start=start, end=end,
        rollback_start=fx.ROLLBACK_START, rollback_end=fx.ROLLBACK_END,
        transaction=TRANSACTION,
        z_upper=Z_UPPER, z_lower=Z_LOWER,
        iqr_lower_quantile=IQR_LOWER, iqr_upper_quantile=IQR_UPPER, iqr_multiplier=IQR_MULTIPLIER,
        ids=IDS,
    )


def q_e1_preprocess(spark, sf_dir):
    return rounded(preprocess_job(spark, sf_dir).output, **{str(y): 6 for y in fx.years(spark, sf_dir)})


# ---- stage 2: adjustment -------------------------------------------------------------------

def parsed_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.year_list(decisions.adjust_flag(fx.decisions(spark, sf_dir)))


def listed_text(c: str = "year"):
    return F.array_join(c, ",")


def adjust_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.filter_adjust(parsed_decisions(spark, sf_dir))


def joined_con(spark: SparkSession, sf_dir: str, check: bool = True) -> DataFrame:
    con = fx.wide(spark, sf_dir, "con")
    return decisions.join_decisions_con(con, adjust_rows(spark, sf_dir), check=check)


def joined_uncon(spark: SparkSession, sf_dir: str, check: bool = True) -> DataFrame:
    con, uncon, rows = fx.wide(spark, sf_dir, "con"), fx.wide(spark, sf_dir, "uncon"), adjust_rows(spark, sf_dir)
    j1 = decisions.join_decisions_con(con, rows, check=False)
    j2 = decisions.join_decisions_uncon(uncon, j1, check=False)
    if check:
        decisions.check_joins([(con, rows, ["area", "parent"], "constrained"), (uncon, j1, IDS, "unconstrained")])
    return j2


def adjust_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The join checks belong to j1/j2/v6 and the adjust job; not repeated per downstream operator.
    long = filters.filter_period(reshape.adjust_long(joined_uncon(spark, sf_dir, check=False)),
                                 *fx.span(spark, sf_dir))
    long = change.rate_of_change(long)
    return cut_lineage(change.flag_rollback_years(long, fx.ROLLBACK_START, fx.ROLLBACK_END))


def imputation(spark: SparkSession, sf_dir: str, extrapolated: bool = True) -> tuple[DataFrame, DataFrame]:
    panel, imputed = impute.safe_years(adjust_panel(spark, sf_dir), *fx.span(spark, sf_dir))
    imputed = impute.interpolate(imputed)
    if extrapolated:
        imputed = impute.extrapolate(panel, imputed)
    return panel, imputed


def apportioned(spark: SparkSession, sf_dir: str, check: bool = True) -> DataFrame:
    panel, imputed = imputation(spark, sf_dir)
    imputed = cut_lineage(imputed.select("area", "period", "imputed"))
    out = cut_lineage(apportion.share_out(panel, imputed))
    if check:
        apportion.check_apportioned(out)
    return out


def rolled_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10-D13 chained; their checks run once on the materialised result."""
    r = apportion.remove_negatives(apportioned(spark, sf_dir, check=False), check=False)
    r = cut_lineage(apportion.rollback_years(r, check=False))
    apportion.check_apportioned(r)
    return r


IMPUTED_COLS = ["area", "period", "rollback_flag", "prev_safe_year", "prev_con", "next_safe_year", "next_con"]


def q_p8_adjust_flag(spark, sf_dir):
    return decisions.adjust_flag(fx.decisions(spark, sf_dir)).select("area", "adjust")


def q_p9_year_list(spark, sf_dir):
    d = parsed_decisions(spark, sf_dir)
    return d.select("area", listed_text().alias("years"), F.size("year").alias("n_years"))


def q_f2_adjust_rows(spark, sf_dir):
    return adjust_rows(spark, sf_dir).select("area", "parent", "adjust", listed_text().alias("year"))


def q_f1_period_range(spark, sf_dir):
    return rounded(filters.filter_period(fx.panel(spark, sf_dir), 1996, 2000).select("area", "period", "uncon"))


def q_f3_component_filter(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    comp = li.groupBy(
        F.col("l_suppkey").alias("supplier"),
        F.year("l_shipdate").cast("int").alias("period"),
        F.col("l_returnflag").alias("sas_code"),
        F.col("l_linestatus").alias("cord_code"),
        F.when(F.col("l_discount") > 0.05, F.lit("D")).otherwise(F.lit("C")).alias("credit_debit"),
    ).agg(F.sum(F.round("l_extendedprice")).alias("value"))
    return rounded(filters.filter_component(comp, "R", "F", "C"))


def q_j1_decision_con(spark, sf_dir):
    j = joined_con(spark, sf_dir)
    return rounded(j.withColumn("year", listed_text()))


def q_j2_decision_uncon(spark, sf_dir):
    j = joined_uncon(spark, sf_dir)
    return rounded(j.withColumn("year", listed_text()))


def q_v6_row_growth(spark, sf_dir):
    con, uncon = fx.wide(spark, sf_dir, "con"), fx.wide(spark, sf_dir, "uncon")
    rows = adjust_rows(spark, sf_dir)
    j1 = decisions.join_decisions_con(con, rows, check=False)
    return decisions.join_counts(con, rows, ["area", "parent"]).withColumn("join", F.lit("constrained")).unionByName(
        decisions.join_counts(uncon, j1, IDS).withColumn("join", F.lit("unconstrained")))


def q_r4_adjust_long(spark, sf_dir):
    long = reshape.adjust_long(joined_uncon(spark, sf_dir))
    return rounded(long.withColumn("year_to_adjust", listed_text("year_to_adjust")))


def q_s3_next_free_year(spark, sf_dir):
    p = fx.panel(spark, sf_dir).withColumn("lst", parse_year_list("listed"))
    return p.select(
        "area", "period", F.array_join("lst", ",").alias("years"),
        previous_free_year("period", "lst", fx.span(spark, sf_dir)[0]).alias("prev_free_year"),
        next_free_year("period", "lst", fx.span(spark, sf_dir)[1]).alias("next_free_year"),
    )


def q_d7_safe_years(spark, sf_dir):
    _, imputed = impute.safe_years(adjust_panel(spark, sf_dir), *fx.span(spark, sf_dir))
    return rounded(imputed.select(*IMPUTED_COLS, listed_text("year_to_adjust").alias("year_to_adjust")))


def q_d8_interpolate(spark, sf_dir):
    _, imputed = imputation(spark, sf_dir, extrapolated=False)
    return rounded(imputed.select(*IMPUTED_COLS, "imputed"))


def q_d9_extrapolate(spark, sf_dir):
    _, imputed = imputation(spark, sf_dir)
    return rounded(imputed.select(*IMPUTED_COLS, "imputed"))


def q_d10_proportions(spark, sf_dir):
    panel, _ = imputation(spark, sf_dir, extrapolated=False)
    p = apportion.proportions(panel)
    return rounded(p.select("area", "parent", "period", "con", "parent_total", "non_outlier_total", "proportion"),
                   proportion=12)


MONEY3 = dict(adjusted_total=3, adjusted_con=3, min_adjusted=3, abs_adjustment=3, over_adjusted=3,
              readjusted_con=3, rollback_con=3, imputed=4)


def q_d11_apportion(spark, sf_dir):
    a = apportioned(spark, sf_dir)
    return rounded(a.select("area", "parent", "period", "con", "imputed", "adjusted_total", "adjusted_con"), **MONEY3)


def q_d12_no_negatives(spark, sf_dir):
    r = apportion.remove_negatives(apportioned(spark, sf_dir))
    return rounded(r.select("area", "parent", "period", "min_adjusted", "abs_adjustment", "over_adjusted",
                            "readjusted_con"), **MONEY3)


def q_d13_rollback_years(spark, sf_dir):
    r = rolled_back(spark, sf_dir)
    return rounded(r.select("area", "parent", "period", "rollback_flag", "readjusted_con", "rollback_con"), **MONEY3)


def q_v1_sum_match(spark, sf_dir):
    """Parent totals before and after, within tolerance or not: of the finished values, and of imputed values that nobody shared out (which break it)."""
    r = rolled_back(spark, sf_dir).withColumn("imputed_only", F.coalesce("imputed", "con"))
    reports = []
    for after in ("rollback_con", "imputed_only"):
        keys = ["parent", "period"]
        bad = checks.sum_mismatches(r, keys, "con", after, apportion.SUM_TOLERANCE, apportion.RELATIVE_TOLERANCE)
        sums = r.groupBy(*keys).agg(F.coalesce(exact_sum("con"), F.lit(0.0)).alias("sum_before"), F.coalesce(exact_sum(after), F.lit(0.0)).alias("sum_after"))
        flagged = bad.select(*keys, F.lit(False).alias("within_tolerance"))
        reports.append(sums.join(flagged, keys, "left").withColumns({
            "within_tolerance": F.coalesce("within_tolerance", F.lit(True)), "values": F.lit(after)}))
    return rounded(reports[0].unionByName(reports[1]), 2)


def q_v2_zero_total(spark, sf_dir):
    p = fx.panel(spark, sf_dir).withColumn("year_to_adjust", parse_year_list("listed"))
    p = p.withColumn("con", F.when((F.col("parent_key") == 3) & (F.col("period") == 1999), F.lit(0.0))
                     .otherwise(F.col("con")))
    return checks.zero_totals(apportion.proportions(p, check=False), ["parent", "period"],
                              "non_outlier_total")


def adjust_job(spark: SparkSession, sf_dir: str, final_value: str = "readjusted") -> jobs.AdjustResult:
    start, end = fx.span(spark, sf_dir)
    return jobs.adjust(
        fx.decisions(spark, sf_dir), fx.wide(spark, sf_dir, "con"), fx.wide(spark, sf_dir, "uncon"),
        start=start, end=end,
        rollback_start=fx.ROLLBACK_START, rollback_end=fx.ROLLBACK_END,
        final_value=final_value, ids=IDS,
    )


def q_r5_final_wide(spark, sf_dir):
    return rounded(adjust_job(spark, sf_dir, "rollback").output, 3)


def q_e2_adjust(spark, sf_dir):
    return rounded(adjust_job(spark, sf_dir).output, 3)


# ---- stage 3: mapping ----------------------------------------------------------------------

def mapping_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjusted wide values per area (the constrained panel pivoted by period)."""
    return fx.wide(spark, sf_dir, "con")


def mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _ = mapping.prefix_rename(mapping_input(spark, sf_dir))
    clean, _ = mapping.clean_mapper(fx.lookup(spark, sf_dir))
    return mapping.join_mapper(df, clean)


def q_p4_prefix_rename(spark, sf_dir):
    df, need = mapping.prefix_rename(mapping_input(spark, sf_dir))
    return rounded(df.withColumn("need_mapping", F.lit(need)))


def q_a11_mapper_distinct(spark, sf_dir):
    return mapping.clean_mapper(fx.lookup(spark, sf_dir))[0]


def q_j13_mapper_join(spark, sf_dir):
    return rounded(mapped(spark, sf_dir))


def q_v12_unmatched(spark, sf_dir):
    return mapping.unmatched(mapped(spark, sf_dir)).select("area", "area_name")


def q_a10_rollup(spark, sf_dir):
    return rounded(mapping.aggregate(mapped(spark, sf_dir), ["mapper_lad_code", "mapper_lad_name"]))


def q_e3_mapping(spark, sf_dir):
    result = jobs.map_geography(mapping_input(spark, sf_dir), fx.lookup(spark, sf_dir), aggregate=True)
    return rounded(result.output)


# ---- sources and sinks ----------------------------------------------------------------------

#: Output file schema (internal name -> file header) and its input twin (fixed values).
FILE_HEADERS = {"area": "Area code", "area_name": "Area name", "parent": "Parent code", "parent_name": "Parent name"}
OUTPUT_SCHEMA = {header: {"old_name": name, "type": "str"} for name, header in FILE_HEADERS.items()}
INPUT_SCHEMA = {name: {"old_name": header, "type": "str"} for name, header in FILE_HEADERS.items()}


#: Cells that need quoting, and one column of each declared type (fixed values).
QUOTED = {"note": {"old_name": "note", "type": "str"}, "rank": {"old_name": "rank", "type": "int"},
          "share": {"old_name": "share", "type": "float"}, "even": {"old_name": "even", "type": "bool"}}


def quoted_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide panel with a text that holds comma, quotes and a newline, and int, float and bool columns."""
    key = F.substring("area", F.lit(2), F.lit(20)).cast("bigint")
    return fx.wide(spark, sf_dir, "uncon").withColumns({
        "note": F.concat(F.col("area_name"), F.lit(', "quoted"\nand \\ more')), "rank": key,
        "share": key / F.lit(4.0), "even": key % 2 == 0})


def q_io1_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "io1")
    csv.write_with_schema(quoted_cells(spark, sf_dir), path, {**OUTPUT_SCHEMA, **QUOTED})
    back = cut_lineage(rounded(csv.read_with_schema(spark, path, {**INPUT_SCHEMA, **QUOTED})))
    remove_path(spark, path)
    return back


#: Declared types of a file some of whose cells do not hold them (fixed values).
SPOILT = {"area": {"old_name": "area", "type": "str"}, "rank": {"old_name": "rank", "type": "int"},
          "share": {"old_name": "share", "type": "float"}, "even": {"old_name": "even", "type": "bool"}}


def spoilt_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of text cells per area: ranks that are no whole numbers, shares with separators, other words than true and false."""
    key = F.substring("area", F.lit(2), F.lit(20)).cast("bigint")
    text = key.cast("string")
    return fx.wide(spark, sf_dir, "uncon").select(
        "area",
        F.when(key % 5 == 1, F.concat(text, F.lit(".5"))).when(key % 7 == 2, F.lit("not known")).when(key % 3 == 0, F.concat(text, F.lit(".0"))).otherwise(text).alias("rank"),
        F.when(key % 4 == 3, F.concat(F.lit("1,"), text)).when(key % 11 == 2, F.lit("n/a")).otherwise(text).alias("share"),
        F.when(key % 6 == 2, F.lit("perhaps")).otherwise((key % 2 == 0).cast("string")).alias("even"),
        F.when(key % 9 == 4, F.lit("12 500")).otherwise(text).alias("1995"))


def q_io4_coercions(spark, sf_dir):
    """Cells of a written file that its schema's types can't hold: column, text and how often."""
    path = scratch_path(spark, "io4")
    csv.write_with_schema(spoilt_cells(spark, sf_dir), path)
    ledger = cut_lineage(csv.read_with_ledger(spark, path, SPOILT).ledger)
    remove_path(spark, path)
    return ledger


def q_v3_negatives(spark, sf_dir):
    """Negative values after an adjustment that takes too much: the panel less 1.25 times the smallest value of its parent and period."""
    p = attach_group_stats(fx.panel(spark, sf_dir), ["parent", "period"], {"smallest": F.min("con")})
    p = p.withColumn("readjusted_con", F.col("con") - F.col("smallest") * 1.25)
    return rounded(checks.negatives(p, "readjusted_con").select("area", "parent", "period", "readjusted_con"))


def q_v4_missing_columns(spark, sf_dir):
    """Columns that the parent totals keep beside the descriptors and the panel lacks (the constraint refuses such tables)."""
    totals = constrain.transaction_totals(totals_long(spark, sf_dir), TRANSACTION, drop_cols=("region", "region_name"))
    return checks.absent_columns(totals, fx.panel(spark, sf_dir).columns)


def spoilt_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions in which some areas list a year twice and some a year out of range."""
    key = F.substring("area", F.lit(2), F.lit(20)).cast("bigint")
    d = fx.decisions(spark, sf_dir).withColumn(
        "year", F.when(key % 5 == 1, F.lit("1999,1999")).when(key % 7 == 2, F.lit("1990, 2001")).otherwise(F.col("year")))
    return decisions.year_list(d)


def q_v7_duplicate_years(spark, sf_dir):
    twice, _ = decisions.year_list_violations(spoilt_decisions(spark, sf_dir), *fx.span(spark, sf_dir))
    return twice.select("area", listed_text().alias("years"))


def q_v8_years_out_of_range(spark, sf_dir):
    _, beyond = decisions.year_list_violations(spoilt_decisions(spark, sf_dir), *fx.span(spark, sf_dir))
    return beyond.select("area", listed_text().alias("years"))


def q_v9_component_presence(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("sas_code"), F.col("l_linestatus").alias("cord_code"), F.col("l_linestatus").alias("credit_debit"))
    return filters.component_presence(li, ("R", "F", "no such code"))


def q_v10_schema_violations(spark, sf_dir):
    """A schema that the panel breaks: a column that isn't there, a text declared int, integers with gaps."""
    p = fx.panel(spark, sf_dir).select("area", F.col("uncon").cast("bigint").alias("uncon"), "con")
    return csv.schema_report(p, {c: {"type": t} for c, t in
                                 (("area", "int"), ("uncon", "int"), ("con", "float"), ("absent", "str"))})


def _one_build(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Run a query with its derived panel built (and materialised) once."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with fx.one_build():
            return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: _one_build(fn) for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adjustment job: one row per area (the preprocess output can be empty on tiny data)."""
    return QUERIES["e2_adjust"](spark, sf_dir)
