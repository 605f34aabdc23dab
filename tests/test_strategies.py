"""One plan at every size: what it looks like, and what it returns when one parent holds a third of all rows."""

import re

from pyspark.sql import functions as F

from panel_edit.operators import apportion, decisions, outliers, reshape
from panel_edit.operators.checks import CheckFailed
from panel_edit.plans import catalog
from panel_edit.plans import fixtures as fx
from tests.conftest import SF_SMALL

import pytest


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_statistics_never_window_a_parent(spark):
    df = spark.range(1000).select(
        (F.col("id") % 3).cast("string").alias("parent"), F.col("id").cast("string").alias("area"),
        (F.col("id") % 7).cast("double").alias("x"), F.lit(False).alias("rollback_flag"))
    plan = _plan(outliers.zscores(df, "bkwd", "parent", "x"))
    assert "Window" not in plan and "partial_avg" in plan


def test_a_second_query_scans_lineitem_once(spark):
    for _ in range(2):
        with fx.one_build():
            plan = _plan(fx.build_panel(spark, SF_SMALL))
        assert len(re.findall(r"FileScan parquet \[[^\]]*l_suppkey", plan)) == 1
    # No frame of an earlier query is cached for the next.
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


def test_one_aggregate_and_two_reads_for_all_scores_of_a_stage(spark, tmp_path):
    spark.range(1000).select(
        (F.col("id") % 3).cast("string").alias("parent"), (F.col("id") % 90).cast("string").alias("area"),
        (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("y"), (F.col("id") % 4).cast("int").alias("period"),
        F.array(F.lit(2)).alias("year_to_adjust"), F.lit(False).alias("rollback_flag")).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    both = outliers.zscores_of(df, {"a": "x", "b": "y"}, "parent")
    one = outliers.zscores(outliers.zscores(df, "a", "parent", "x"), "b", "parent", "y")
    assert sorted(map(str, both.select(one.columns).collect())) == sorted(map(str, one.collect()))
    shared = apportion.share_out(df, spark.createDataFrame([("1", 2, 5.0)], "area string, period int, imputed double"), value="x")
    for plan in (_plan(both), _plan(shared)):
        assert len(re.findall(r"FileScan parquet", plan)) == 2 and "Window" not in plan


def test_pairs_from_one_pivot_equal_two_pivots(spark):
    rows = [(a, f"n{a}", "p", "P", y, float(a * y), float(a + y), None if y == 2001 else 1.5, 2.5, True, "TRUE") for a in (1, 2) for y in (2000, 2001)]
    df = spark.createDataFrame(rows, "area int, area_name string, parent string, parent_name string, period int, u double, c double, m double, n double, "
                                     "master_z_flag boolean, master_flag string")
    got = reshape.metric_pairs_wide(df, [2000, 2001], {"TRUE": ("u", "c"), "MEAN": ("m", "n")})
    want = [reshape.metrics_wide(reshape.metrics_long(df.drop(*gone), a, b), [2000, 2001]).withColumn("master_flag", F.lit(flag))
            for flag, a, b, gone in (("TRUE", "u", "c", ["m", "n"]), ("MEAN", "m", "n", ["u", "c"]))]
    assert got.columns == want[0].columns
    assert sorted(map(str, got.collect())) == sorted(str(r) for w in want for r in w.collect())


def test_every_violation_class_is_told_in_step_order(spark):
    moved = [("p%02d" % i, 1, 10.0, 11.0, 5.0) for i in range(25)]
    zero = [("q", 1, 10.0, 10.0, 0.0)]
    df = spark.createDataFrame(moved + zero, "parent string, period int, con double, adjusted_con double, non_outlier_total double")
    with pytest.raises(CheckFailed, match=r"zero non_outlier_total.* in 1 "):
        apportion.check_apportioned(df)
    with pytest.raises(CheckFailed, match=r"do not match.* in 25 .*first 10"):
        apportion.check_apportioned(df.where("parent <> 'q'"))
    lists = spark.createDataFrame([([1990],)] * 25 + [([2000, 2000],)], "year array<int>")
    with pytest.raises(CheckFailed, match="duplicate years.* in 1 rows"):
        decisions.check_year_lists(lists, 1995, 2001)
    with pytest.raises(CheckFailed, match="out of the valid range 1995-2001 in 25 rows"):
        decisions.check_year_lists(lists.where("year[0] = 1990"), 1995, 2001)


def test_hard_branches_are_reached(spark):
    sf = "/root/testdata/sf0.01"
    assert catalog.QUERIES["d12_no_negatives"](spark, sf).where("abs_adjustment > 0").count() > 0
    assert catalog.QUERIES["d9_extrapolate"](spark, sf).where("imputed is null").count() > 0
    assert catalog.QUERIES["e1_preprocess"](spark, sf).count() > 0
    w = catalog.QUERIES["w1_forward"](spark, sf)
    assert w.where("forward_pct_change is null").count() > 100
