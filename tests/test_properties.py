"""Invariants over many random cases at once (one Spark job per property)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panel_edit.operators import apportion, change

POSITIVE = st.floats(min_value=0.5, max_value=1e6, allow_nan=False, allow_infinity=False)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.lists(POSITIVE, min_size=2, max_size=8), min_size=60, max_size=60))
def test_forward_and_backward_ratios_are_reciprocal(spark, series):
    data = [(f"a{i}", 2000 + t, v) for i, s in enumerate(series) for t, v in enumerate(s)]
    df = spark.createDataFrame(data, "area string, period int, uncon double")
    out = {(r.area, r.period): r for r in change.rate_of_change(df).collect()}
    for (area, period), r in out.items():
        nxt = out.get((area, period + 1))
        if nxt is not None:
            assert math.isclose(r.backward_pct_change * nxt.forward_pct_change, 1.0, rel_tol=1e-9)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.lists(POSITIVE, min_size=3, max_size=6), st.integers(0, 2), POSITIVE,
                          st.floats(min_value=-0.9, max_value=2.0)), min_size=80, max_size=80))
def test_apportioning_preserves_parent_totals(spark, groups):
    rows = []
    for g, (values, n_listed, imputed_scale, shift) in enumerate(groups):
        # The first area is never listed, so every group keeps a non-outlier total.
        listed = set(range(1, 1 + min(n_listed, len(values) - 1)))
        for a, v in enumerate(values):
            rows.append((f"g{g}a{a}", f"p{g}", 2000, v, [2000] if a in listed else [],
                         imputed_scale * (1 + shift) if a in listed else None))
    df = spark.createDataFrame(rows, "area string, parent string, period int, con double, "
                                     "year_to_adjust array<int>, imp double")
    imputed = df.where(F.col("imp").isNotNull()).select("area", "period", F.col("imp").alias("imputed"))
    # Large imputations drive other rows negative: the negative pass must still keep the totals.
    out = apportion.proportions(df.drop("imp"))
    out = apportion.apportion(out, imputed, relative=1e-9)
    out = apportion.remove_negatives(out, relative=1e-9)
    sums = out.groupBy("parent").agg(F.sum("con").alias("c"), F.sum("readjusted_con").alias("r"),
                                     F.min("readjusted_con").alias("m")).collect()
    assert len(sums) == len(groups)
    for s in sums:
        assert math.isclose(s.c, s.r, rel_tol=1e-9) and s.m >= -1e-9 * abs(s.c)
