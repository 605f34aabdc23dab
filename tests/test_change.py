import math

from pyspark.sql import functions as F

from panel_edit.operators import change
from tests.conftest import rows


def test_ratios_fill_gaps_and_use_row_neighbours(spark):
    df = spark.createDataFrame(
        [("a", 2003, 12.0), ("a", 2001, 10.0), ("a", 2002, None), ("a", 2004, 6.0), ("b", 2001, 4.0),
         ("b", 2003, 8.0)],
        "area string, period int, uncon double",
    )
    out = change.rate_of_change(df)
    got = {(r.area, r.period): (r.forward_pct_change, r.backward_pct_change) for r in out.collect()}
    # Forward: 10, (10), 12, 6 -> null, 1.0, 1.2, 0.5
    assert got[("a", 2001)][0] is None
    assert got[("a", 2002)][0] == 1.0
    assert math.isclose(got[("a", 2003)][0], 1.2)
    assert math.isclose(got[("a", 2004)][0], 0.5)
    # Backward fills from the later row: 10/12, (12)/12, 12/6, last null
    assert math.isclose(got[("a", 2001)][1], 10 / 12)
    assert got[("a", 2002)][1] == 1.0
    assert math.isclose(got[("a", 2003)][1], 2.0)
    assert got[("a", 2004)][1] is None
    # Neighbour is the previous row, not the previous calendar year.
    assert math.isclose(got[("b", 2003)][0], 2.0)


def test_zero_base_null_or_inf(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 5.0), ("a", 3, 0.0)], "area string, period int, uncon double")
    null = {r.period: r.forward_pct_change for r in change.rate_of_change(df).collect()}
    assert null[2] is None
    inf = {r.period: r.forward_pct_change for r in change.rate_of_change(df, zero_base="inf").collect()}
    assert inf[2] == float("inf") and inf[3] == 0.0


def test_rollback_flag_inside_range_only(spark):
    df = spark.createDataFrame(
        [("a", 2010, 1.0, None), ("a", 2011, 1.2, 1.0), ("a", 2015, 1.0, 0.9), ("a", 2012, None, None),
         ("a", 2013, 0.5, 2.0)],
        "area string, period int, backward_pct_change double, forward_pct_change double",
    )
    out = change.flag_rollback_years(df, 2010, 2014)
    assert rows(out, "period", "rollback_flag") == [
        (2010, True), (2011, True), (2012, False), (2013, False), (2015, False)]


def test_one_exchange_for_both_ratios(spark):
    df = spark.range(100).select(
        (F.col("id") % 10).cast("string").alias("area"), (F.col("id") / 10).cast("int").alias("period"),
        F.col("id").cast("double").alias("uncon"))
    plan = change.rate_of_change(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
