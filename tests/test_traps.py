"""Semantic traps the reference's own tests do not cover."""

import pytest
from pyspark.sql import functions as F

from panel_edit.operators import apportion, checks, mapping, outliers
from panel_edit.plans import catalog, jobs
from panel_edit.plans import fixtures as fx
from tests.conftest import SF_SMALL, rows


def test_sum_over_missing_values_is_zero(spark):  # T5
    df = spark.createDataFrame([("a", "P", 1, None, []), ("b", "P", 1, None, [])],
                               "area string, parent string, period int, con double, year_to_adjust array<int>")
    out = apportion.proportions(df, check=False)
    assert {r.parent_total for r in out.collect()} == {0.0}
    with pytest.raises(checks.CheckFailed, match="Non-outlier"):
        apportion.proportions(df)


def test_master_flag_iqr_only(spark):
    df = spark.createDataFrame([("a", 1, True, True), ("a", 2, False, False), ("b", 1, True, False)],
                               "area string, period int, z_bkwd_flag boolean, iqr_raw_flag boolean")
    out = outliers.master_flag(df.drop("z_bkwd_flag"), zscore=False, iqr=True)
    assert rows(out, "area", "master_flag") == [("a", True), ("a", True), ("b", False)]
    assert "master_z_flag" not in out.columns


def test_missing_extrapolation_point_leaves_the_row_empty(spark):  # T14
    df = spark.createDataFrame(
        [("a", "P", 1, 10.0, [1], 1.0), ("b", "P", 1, 30.0, [], 1.0)],
        "area string, parent string, period int, con double, year_to_adjust array<int>, x double")
    p = apportion.proportions(df)
    imputed = spark.createDataFrame([("a", 1, None)], "area string, period int, imputed double")
    # Sums skip the missing value: the unlisted rows take the whole parent total, the check passes.
    out = apportion.apportion(p, imputed)
    assert rows(out, "area", "adjusted_con") == [("a", None), ("b", 40.0)]


def test_partial_rollback_in_a_group_fails_the_sum_check(spark):  # T15
    df = spark.createDataFrame(
        [("a", "P", 1, 5.0, 5.0, True), ("b", "P", 1, 5.0, 5.0, False), ("a", "P", 2, 2.0, 2.0, True),
         ("b", "P", 2, 8.0, 8.0, True)],
        "area string, parent string, period int, con double, readjusted_con double, rollback_flag boolean")
    df = apportion.attach_group_stats(df, ["parent", "period"], {"parent_total": F.sum("con")})
    with pytest.raises(checks.CheckFailed, match="parent sums"):
        apportion.rollback_years(df)


def test_accepting_negatives_uses_adjusted_values(spark):  # T11
    with fx.one_build():
        start, end = fx.span(spark, SF_SMALL)
        args = dict(start=start, end=end, rollback_start=fx.ROLLBACK_START,
                    rollback_end=fx.ROLLBACK_END, ids=catalog.IDS)
        kept = jobs.adjust(fx.decisions(spark, SF_SMALL), fx.wide(spark, SF_SMALL, "con"), fx.wide(spark, SF_SMALL, "uncon"),
                           accept_negatives=True, **args)
        assert "readjusted_con" not in kept.interim.columns and "rollback_con" in kept.interim.columns
        base = jobs.adjust(fx.decisions(spark, SF_SMALL), fx.wide(spark, SF_SMALL, "con"), fx.wide(spark, SF_SMALL, "uncon"), **args)
        # No negatives in this panel: rescaling is the identity up to rounding.
        def cells(df):
            return sorted((r.area, [None if r[str(y)] is None else round(r[str(y)], 3) for y in range(start, end + 1)]) for r in df.collect())

        a, b = cells(kept.output), cells(base.output)
        assert a == b


def test_lookup_mapping_a_unit_twice_is_reported(spark):  # T22
    m = spark.createDataFrame([("L1", "One", "S301", "u"), ("L2", "Two", "S301", "u"), ("L3", "Three", "S302", "v")],
                              "mapper_lad_code string, mapper_lad_name string, mapper_lau_code string, "
                              "mapper_lau_name string")
    assert rows(mapping.ambiguous_units(m), "mapper_lau_code", "n_targets") == [("S301", 2)]
    data = spark.createDataFrame([("a", "S301", "n", 1.0)], "area string, parent string, parent_name string, "
                                                            "`2020` double")
    res = jobs.map_geography(data, m)
    assert res.need_mapping and res.output.count() == 2 and res.ambiguous.count() == 1


def test_duplicate_parent_totals_are_rejected(spark):  # T22 / V11 for the totals
    with fx.one_build():
        start, end = fx.span(spark, SF_SMALL)
        totals = fx.parent_totals(spark, SF_SMALL)
        with pytest.raises(checks.CheckFailed, match="duplicate parent totals"):
            jobs.preprocess(fx.wide(spark, SF_SMALL, "uncon"), totals.unionByName(totals), start=start, end=end,
                            rollback_start=fx.ROLLBACK_START, rollback_end=fx.ROLLBACK_END,
                            transaction=catalog.TRANSACTION, ids=catalog.IDS)


def test_missing_identifiers_are_rejected(spark):  # T7: no "nan" codes, missing codes stop the job
    wide = spark.createDataFrame(
        [("a", "an", "P", "pn", 1.0, 2.0), (None, "bn", "P", "pn", 3.0, 4.0)],
        "area string, area_name string, parent string, parent_name string, `2001` double, `2002` double")
    dec = spark.createDataFrame([("a", "an", "P", "pn", "TRUE", "2001")],
                                "area string, area_name string, parent string, parent_name string, adjust string, "
                                "year string")
    with pytest.raises(checks.CheckFailed, match="without an area or parent code"):
        jobs.adjust(dec, wide, wide, start=2001, end=2002, rollback_start=1990, rollback_end=1990)
