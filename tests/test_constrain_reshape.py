import math

import pytest

from panel_edit.operators import constrain, reshape
from tests.conftest import rows


def test_parent_mean_uses_unflagged_areas_and_keeps_flagged_rows(spark):
    df = spark.createDataFrame(
        [("a", "P", 1, 10.0, True), ("b", "P", 1, 20.0, False), ("c", "P", 1, 40.0, False),
         ("d", "Q", 1, 5.0, True), ("e", "Q", 1, 7.0, True)],
        "area string, parent string, period int, uncon double, master_flag boolean")
    out = constrain.parent_mean(df)
    assert rows(out, "area", "mean_non_outlier") == [("a", 30.0), ("d", None), ("e", None)]


def test_constrain_scales_value_and_mean_to_parent_total(spark):
    df = spark.createDataFrame(
        [("a", "P", 1, 10.0, 30.0, True), ("b", "P", 2, -30.0, 30.0, True), ("c", "P", 3, 100.0, 100.5, False)],
        "area string, parent string, period int, uncon double, mean_non_outlier double, master_flag boolean")
    totals = spark.createDataFrame(
        [("R", "P", "Reg", "T1", "Income", 1, "200"), ("R", "P", "Reg", "T1", "Income", 2, "50"),
         ("R", "P", "Reg", "T1", "Income", 3, "1,200.5"), ("R", "P", "Reg", "T2", "Other", 1, "9,999")],
        "region string, parent string, region_name string, transaction_code string, transaction string, "
        "period int, uncon string")
    out = {r.area: r for r in constrain.constrain_to_parent_totals(df, totals, "Income").collect()}
    assert (out["a"].con_area, out["a"].con_mean, out["a"].master_flag) == (50.0, 150.0, "TRUE")
    assert (out["b"].con_area, out["b"].con_mean) == (0.0, 0.0)  # zero denominator -> rate 0
    assert math.isclose(out["c"].con_area, 100.0 * 1200.5 / 200.5) and out["c"].master_flag == "MEAN"


def test_constrain_rejects_unknown_total_columns(spark):
    df = spark.createDataFrame([("a", "P", 1, 1.0, 1.0, True)],
                               "area string, parent string, period int, uncon double, mean_non_outlier double, "
                               "master_flag boolean")
    totals = spark.createDataFrame([("P", 1, "1", "Income", "x")],
                                   "parent string, period int, uncon string, transaction string, extra string")
    with pytest.raises(ValueError, match="lacks"):
        constrain.constrain_to_parent_totals(df, totals, "Income", drop_cols=("transaction",))


def test_union_sorted_puts_values_before_mean(spark):
    a = spark.createDataFrame([("x", 1.0, "TRUE"), ("w", 2.0, "TRUE")], "area string, v double, master_flag string")
    b = spark.createDataFrame([("x", 3.0, "MEAN", "m")], "area string, v double, master_flag string, extra string")
    got = [(r.area, r.master_flag, r.extra) for r in constrain.union_sorted(a, b).collect()]
    assert got == [("w", "TRUE", None), ("x", "TRUE", None), ("x", "MEAN", "m")]


def test_wide_long_round_trip(spark):
    wide = spark.createDataFrame([("a", "P", 1.0, 2.0, 3.0), ("b", "P", 4.0, None, 6.0)],
                                 "area string, parent string, `2001` double, `2002` double, `2003` double")
    long = reshape.wide_to_long(wide, "period", "value")
    assert long.count() == 6 and dict(long.dtypes)["period"] == "int"
    pruned = reshape.wide_to_long(wide, "period", "value", periods=(2002, 2003))
    assert sorted({r.period for r in pruned.collect()}) == [2002, 2003]
    back = reshape.final_wide(long, [2001, 2002, 2003], "value", ids=("area", "parent"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


def test_metrics_long_and_wide(spark):
    df = spark.createDataFrame(
        [("a", "an", "P", "pn", 2001, 1.0, 10.0, "TRUE"), ("a", "an", "P", "pn", 2002, 2.0, 20.0, "TRUE")],
        "area string, area_name string, parent string, parent_name string, period int, uncon double, "
        "con_area double, master_flag string")
    long = reshape.metrics_long(df, "uncon", "con_area")
    assert sorted(r.metric_date for r in long.collect()) == ["CONLSOA_2001", "CONLSOA_2002", "uncon_2001",
                                                            "uncon_2002"]
    wide = reshape.metrics_wide(long, [2001, 2002])
    assert wide.columns == ["area", "area_name", "parent", "parent_name", "2001", "2002", "master_flag",
                            "CONLSOA_2001", "CONLSOA_2002"]
    r = wide.first()
    assert (r["2001"], r["CONLSOA_2002"]) == (1.0, 20.0)
    assert reshape.metric_duplicates(long.unionByName(long)).count() == 4


def test_adjust_long_pairs_columns_in_one_pass(spark):
    df = spark.createDataFrame(
        [("a", "an", "P", "pn", 1.0, 2.0, 10.0, 99.0, True, [2001])],
        "area string, area_name string, parent string, parent_name string, `2001` double, `2002` double, "
        "CON_2001 double, CON_1999 double, adjust boolean, year array<int>")
    out = reshape.adjust_long(df)
    assert rows(out, "period", "uncon", "con") == [(2001, 1.0, 10.0), (2002, 2.0, None)]
    assert out.first().year_to_adjust == [2001]
