import math

import pytest

from panel_edit.operators import apportion, checks, decisions, filters, impute
from tests.conftest import rows


def _series(spark, listed, values, rollback=()):
    data = [("a", "P", y, float(v), listed, y in rollback) for y, v in values]
    return spark.createDataFrame(
        data, "area string, parent string, period int, con double, year_to_adjust array<int>, rollback_flag boolean")


def test_safe_years_interpolate_and_extrapolate(spark):
    vals = [(2000, 10), (2001, 15), (2002, 99), (2003, 40), (2004, 50), (2005, 60), (2006, 70), (2007, 80)]
    df = _series(spark, [2001, 2002], vals, rollback=(2001,))
    panel, imp = impute.safe_years(df, 2000, 2007)
    imp = impute.interpolate(imp)
    got = {r.period: r for r in imp.collect()}
    assert (got[2001].prev_safe_year, got[2001].next_safe_year) == (2000, 2003)
    assert (got[2002].prev_con, got[2002].next_con) == (10.0, 40.0)
    assert got[2001].imputed is None and math.isclose(got[2002].imputed, 30.0)
    done = {r.period: r.imputed for r in impute.extrapolate(panel, imp).collect()}
    # Rollback row: line through 2003 (40) and 2007 (80), back to 2001.
    assert math.isclose(done[2001], 20.0) and math.isclose(done[2002], 30.0)


def test_extrapolate_backwards_and_lookup_join_path(spark):
    vals = [(1999, 0), (2000, 10), (2001, 20), (2002, 30), (2003, 40), (2004, 5)]
    df = _series(spark, [2004], vals)
    panel, imp = impute.safe_years(df, 2000, 2004)
    imp = impute.interpolate(imp)
    r = imp.first()
    assert (r.prev_safe_year, r.next_safe_year, r.next_con) == (2003, 2005, None)
    via_map = impute.extrapolate(panel, imp).first().imputed
    via_join = impute.extrapolate(panel, imp.drop(impute.SERIES)).first().imputed
    assert via_map == via_join == 50.0


def test_safe_years_at_range_start(spark):
    df = _series(spark, [2000, 2001], [(2000, 1), (2001, 2), (2002, 3)])
    _, imp = impute.safe_years(df, 2000, 2002)
    assert rows(imp, "period", "prev_safe_year", "prev_con", "next_safe_year", "next_con") == [
        (2000, 1999, None, 2002, 3.0), (2001, 1999, None, 2002, 3.0)]


def test_proportions_apportion_and_zero_total(spark):
    data = [("a", "P", 1, 10.0, [1]), ("b", "P", 1, 30.0, []), ("c", "P", 1, 10.0, None)]
    df = spark.createDataFrame(data, "area string, parent string, period int, con double, year_to_adjust array<int>")
    p = apportion.proportions(df)
    got = {r.area: r for r in p.collect()}
    assert got["a"].parent_total == 50.0 and got["a"].non_outlier_total is None and got["a"].proportion is None
    assert got["b"].proportion == 0.75
    imputed = spark.createDataFrame([("a", 1, 18.0)], "area string, period int, imputed double")
    out = {r.area: r.adjusted_con for r in apportion.apportion(p, imputed).collect()}
    assert out == {"a": 18.0, "b": 24.0, "c": 8.0}
    zero = spark.createDataFrame([("a", "P", 1, 0.0, []), ("b", "P", 1, 5.0, [1])],
                                 "area string, parent string, period int, con double, year_to_adjust array<int>")
    with pytest.raises(checks.CheckFailed, match="Non-outlier total"):
        apportion.proportions(zero)


def test_remove_negatives_shifts_and_rescales(spark):
    data = [("a", "P", 1, 3.0, -2.0), ("b", "P", 1, 3.0, 3.0), ("c", "P", 1, 3.0, 5.0), ("d", "P", 1, 3.0, 6.0),
            ("a", "P", 2, 2.0, 2.0), ("b", "P", 2, 3.0, 3.0)]
    df = spark.createDataFrame(data, "area string, parent string, period int, con double, adjusted_con double")
    df = apportion.attach_group_stats(df, ["parent", "period"], {"parent_total": apportion.F.sum("con")})
    out = {(r.area, r.period): r for r in apportion.remove_negatives(df).collect()}
    assert [out[(k, 1)].readjusted_con for k in "abcd"] == pytest.approx([0.0, 3.0, 4.2, 4.8])
    assert out[("a", 1)].abs_adjustment == 2.0 and out[("a", 2)].abs_adjustment == 0.0
    assert (out[("a", 2)].readjusted_con, out[("b", 2)].readjusted_con) == pytest.approx((2.0, 3.0))
    neg = spark.createDataFrame([("a", "P", 1, -1.0, -1.0, -3.0), ("b", "P", 1, -2.0, -2.0, -3.0)],
                                "area string, parent string, period int, con double, adjusted_con double, "
                                "parent_total double")
    with pytest.raises(checks.CheckFailed, match="Negative value"):
        apportion.remove_negatives(neg)


def test_rollback_years_share_like_last_copied_period(spark):
    data = [("a", 2000, 5.0, 4.0, True), ("b", 2000, 5.0, 6.0, True), ("a", 2001, 6.0, 3.0, True),
            ("b", 2001, 6.0, 9.0, True), ("a", 2002, 4.0, 5.0, False), ("b", 2002, 6.0, 5.0, False)]
    df = spark.createDataFrame(data, "area string, period int, con double, readjusted_con double, "
                                     "rollback_flag boolean").withColumn("parent", apportion.F.lit("P"))
    df = apportion.attach_group_stats(df, ["parent", "period"], {"parent_total": apportion.F.sum("con")})
    out = {(r.area, r.period): r.rollback_con for r in apportion.rollback_years(df).collect()}
    assert out == pytest.approx({("a", 2000): 2.5, ("b", 2000): 7.5, ("a", 2001): 3.0, ("b", 2001): 9.0,
                                 ("a", 2002): 5.0, ("b", 2002): 5.0})
    none = df.withColumn("rollback_flag", apportion.F.lit(False))
    assert {r.rollback_con for r in apportion.rollback_years(none, check=False).collect()} == {3.0, 4.0, 5.0, 6.0, 9.0}


def test_sum_check_absolute_and_relative(spark):
    df = spark.createDataFrame([("P", 1, 1e9, 1e9 + 5e-7), ("Q", 1, 1.0, 1.0001)],
                               "parent string, period int, u double, a double")
    strict = checks.sum_mismatches(df, ["parent"], "u", "a", 1e-6)
    assert rows(strict, "parent") == [("Q",)]
    with pytest.raises(checks.CheckFailed):
        checks.require(strict, "sums differ")


def test_adjust_flag_and_year_list(spark):
    df = spark.createDataFrame(
        [("a", "TRUE", "2002"), ("b", "FALSE", "2002, 2003"), ("c", None, None), ("d", "true", ""),
         ("e", "TRUE", " 2004 ,2005 "), ("f", "x", "2006.0,nan")], "area string, adjust string, year string")
    out = decisions.year_list(decisions.adjust_flag(df))
    assert rows(out, "area", "adjust", "year") == [
        ("a", True, [2002]), ("b", False, [2002, 2003]), ("c", False, []), ("d", True, []),
        ("e", True, [2004, 2005]), ("f", False, [2006])]
    bad = decisions.year_list(spark.createDataFrame([("a", "20a")], "area string, year string"))
    with pytest.raises(Exception):
        bad.collect()


def test_year_list_checks(spark):
    df = decisions.year_list(spark.createDataFrame([("a", "2002,2002"), ("b", "1990")], "area string, year string"))
    dups, out = decisions.year_list_violations(df, 2000, 2010)
    assert rows(dups, "area") == [("a",)] and rows(out, "area") == [("b",)]
    with pytest.raises(checks.CheckFailed, match="duplicate years"):
        decisions.check_year_lists(df, 2000, 2010)
    nulls = spark.createDataFrame([("a", [2001, None])], "area string, year array<int>")
    with pytest.raises(checks.CheckFailed, match="not a number"):
        decisions.check_year_lists(nulls, 2000, 2010)


def test_filters(spark):
    df = spark.createDataFrame([("a", "P", True, [1], 1), ("b", "P", None, [2], 2), ("c", "P", False, [], 3)],
                               "area string, parent string, adjust boolean, year array<int>, period int")
    assert rows(decisions.filter_adjust(df), "area") == [("a",)]
    assert rows(filters.filter_period(df, 2, 3), "area") == [("b",), ("c",)]
    comp = spark.createDataFrame([("s1", "c1", "C", 1), ("s1", "c2", "D", 2), ("s2", "c1", "C", 3)],
                                 "sas_code string, cord_code string, credit_debit string, value int")
    assert rows(filters.filter_component(comp, "s1", "c1", "C"), "value") == [(1,)]
    with pytest.raises(checks.CheckFailed, match="CORD code 'zz'"):
        filters.filter_component(comp, "s1", "zz", "C")


def test_decision_joins_check_rows(spark):
    con = spark.createDataFrame([("a", "an", "P", "pn", 1.0), ("b", "bn", "P", "pn", 2.0)],
                                "area string, area_name string, parent string, parent_name string, `2001` double")
    dec = spark.createDataFrame([("a", "P", True, [2001])], "area string, parent string, adjust boolean, year array<int>")
    j = decisions.join_decisions_con(con, dec)
    assert "CON_2001" in j.columns and "area_name" in j.columns
    dup = dec.unionByName(dec)
    with pytest.raises(checks.CheckFailed):
        decisions.join_decisions_con(con, dup)
    lost = spark.createDataFrame([("zz", "P", True, [2001])], "area string, parent string, adjust boolean, "
                                                              "year array<int>")
    with pytest.raises(checks.CheckFailed, match="do not match"):
        decisions.join_decisions_con(con, lost)
    uncon = con.withColumnRenamed("2001", "2002")
    j2 = decisions.join_decisions_uncon(uncon, j)
    assert rows(j2, "area", "adjust") == [("a", True), ("b", False)]
