"""Operators against plain Python computations on small tables of our own."""

import math
import random

import pytest
from pyspark.sql import functions as F

from panel_edit.operators import apportion, change, constrain, impute, mapping, outliers, reshape
from tests.conftest import rows

PANEL = "area string, parent string, period int, con double, uncon double, year_to_adjust array<int>, rollback_flag boolean"


def _panel(seed, areas=9, parents=("north", "south"), years=range(2011, 2017), listed=()):
    """``{(area, period): row}`` with values from a seeded generator."""
    rnd = random.Random(seed)
    out = {}
    for i in range(areas):
        for y in years:
            name = f"zone{i}"
            out[name, y] = dict(area=name, parent=parents[i % len(parents)], period=y, con=float(rnd.randint(40, 900)),
                                uncon=float(rnd.randint(40, 900)), year_to_adjust=list(dict(listed).get(name, ())), rollback_flag=False)
    return out


def _df(spark, table):
    return spark.createDataFrame([tuple(r.values()) for r in table.values()], PANEL)


def test_ratios_against_neighbouring_periods(spark):
    t = _panel(1)
    got = change.rate_of_change(_df(spark, t)).collect()
    assert len(got) == len(t)
    for r in got:
        before, after = t.get((r.area, r.period - 1)), t.get((r.area, r.period + 1))
        for name, other in (("forward_pct_change", before), ("backward_pct_change", after)):
            want = None if other is None else r.uncon / other["uncon"]
            assert (r[name] is None) == (want is None) and (want is None or math.isclose(r[name], want, rel_tol=1e-9))


def test_zero_and_missing_bases_give_no_ratio_of_infinity(spark):
    df = spark.createDataFrame([("z", 1, 0.0), ("z", 2, 6.0), ("z", 3, None), ("z", 4, 9.0)], "area string, period int, uncon double")
    got = {r.period: r for r in change.rate_of_change(df).collect()}
    assert got[2].forward_pct_change is None  # 6 / 0
    assert got[3].forward_pct_change == 1.0  # a gap takes over its neighbour
    assert got[4].forward_pct_change == 1.5


@pytest.mark.parametrize("listed", [(2012, 2013), (2011,), (2016,), (2013, 2014, 2015, 2016), tuple(range(2011, 2017))])
def test_imputation_on_the_line_through_safe_periods(spark, listed):
    t = _panel(2, areas=3, listed={"zone1": listed})
    panel, imputed = impute.safe_years(_df(spark, t), 2011, 2016)
    got = {r.period: r.imputed for r in impute.extrapolate(panel, impute.interpolate(imputed)).collect()}
    assert sorted(got) == sorted(listed)
    value = lambda y: t["zone1", y]["con"] if ("zone1", y) in t else None
    for y in listed:
        lo = next(k for k in range(y, 2009, -1) if k not in listed)
        hi = next(k for k in range(y, 2019) if k not in listed)
        if value(lo) is not None and value(hi) is not None:
            points = (lo, hi)
        elif value(lo) is None:
            points = (hi, hi + impute.EXTRAPOLATION_GAP)
        else:
            points = (lo - impute.EXTRAPOLATION_GAP, lo)
        p, q = map(value, points)
        if p is None or q is None:
            assert got[y] is None
        else:
            assert math.isclose(got[y], p + (q - p) / (points[1] - points[0]) * (y - points[0]), rel_tol=1e-9)


def _apportioned(spark, t, imputed):
    df = _df(spark, t)
    extra = spark.createDataFrame([(a, y, v) for (a, y), v in imputed.items()], "area string, period int, imputed double")
    return apportion.apportion(apportion.proportions(df), extra)


def test_apportioning_keeps_totals_and_shares(spark):
    t = _panel(3, listed={"zone0": (2012,), "zone3": (2012, 2014)})
    imputed = {("zone0", 2012): 333.0, ("zone3", 2012): 5.0, ("zone3", 2014): 77.5}
    got = {(r.area, r.period): r.adjusted_con for r in _apportioned(spark, t, imputed).collect()}
    assert len(got) == len(t)
    for key, r in t.items():
        group = [k for k, o in t.items() if (o["parent"], o["period"]) == (r["parent"], r["period"])]
        if key in imputed:
            assert got[key] == imputed[key]
            continue
        free = sum(t[k]["con"] for k in group if k not in imputed)
        left = sum(t[k]["con"] for k in group) - sum(imputed[k] for k in group if k in imputed)
        assert math.isclose(got[key], r["con"] / free * left, rel_tol=1e-9)


def test_negatives_are_shifted_away_and_totals_stay(spark):
    t = _panel(4, listed={"zone0": (2013,)})
    big = {("zone0", 2013): 1e5}  # more than its parent's total: the others turn negative
    a = _apportioned(spark, t, big)
    assert a.where("adjusted_con < 0").count() > 0
    got = apportion.remove_negatives(a).collect()
    assert any(r.abs_adjustment > 0 for r in got) and all(r.readjusted_con >= 0 for r in got)
    for parent, period in {(r.parent, r.period) for r in got}:
        group = [r for r in got if (r.parent, r.period) == (parent, period)]
        assert math.isclose(sum(r.readjusted_con for r in group), sum(r.con for r in group), rel_tol=1e-9)


def test_rollback_periods_share_like_the_last_of_them(spark):
    t = _panel(5)
    for (_, y), r in t.items():
        r["rollback_flag"] = y <= 2012
    df = _df(spark, t).withColumn("readjusted_con", F.col("con")).join(
        _df(spark, t).groupBy("parent", "period").agg(F.sum("con").alias("parent_total")), ["parent", "period"])
    got = apportion.rollback_years(df).collect()
    assert len(got) == len(t)
    for r in got:
        last = sum(o["con"] for o in t.values() if o["parent"] == r.parent and o["period"] == 2012)
        want = r.parent_total * t[r.area, 2012]["con"] / last if r.period <= 2012 else r.con
        assert math.isclose(r.rollback_con, want, rel_tol=1e-9)


def test_constrained_pairs_meet_the_parent_total(spark):
    t = _panel(6)
    df = _df(spark, t).select("area", "parent", "period", "uncon", (F.col("area") == "zone2").alias("master_flag"))
    flagged = constrain.parent_mean(df)
    totals = spark.createDataFrame([("north", y, f"{1000 * y:,}", "income") for y in range(2011, 2017)],
                                   "parent string, period int, uncon string, transaction string")
    got = constrain.constrain_to_parent_totals(flagged, totals, "income").collect()
    assert len(got) == 6
    for r in got:
        mean = [o["uncon"] for o in t.values() if (o["parent"], o["period"]) == ("north", r.period) and o["area"] != "zone2"]
        assert math.isclose(r.mean_non_outlier, sum(mean) / len(mean), rel_tol=1e-12)
        assert math.isclose(r.con_area + r.con_mean, 1000.0 * r.period, rel_tol=1e-9)
        assert math.isclose(r.con_area / r.con_mean, r.uncon / r.mean_non_outlier, rel_tol=1e-9)


def test_zero_denominator_constrains_to_zero(spark):
    df = spark.createDataFrame([("a", "p", 1, 5.0, -5.0, True)], "area string, parent string, period int, uncon double, mean_non_outlier double, master_flag boolean")
    totals = spark.createDataFrame([("p", 1, "70", "t")], "parent string, period int, uncon string, transaction string")
    r = constrain.constrain_to_parent_totals(df, totals, "t").first()
    assert (r.con_area, r.con_mean) == (0.0, 0.0)


def test_rows_without_a_parent_get_no_statistics(spark):
    df = spark.createDataFrame([(None, 1, float(v), False) for v in (1, 2, 3, 90)] + [("p", 1, float(v), False) for v in (1, 2, 3, 90)],
                               "parent string, period int, uncon double, rollback_flag boolean")
    got = outliers.iqr_fences(df, "raw", ["parent", "period"], "uncon", multiplier=1.0).collect()
    assert len(got) == 8
    assert all((r.raw_q1 is None) == (r.parent is None) for r in got)
    assert not any(r.iqr_raw_flag for r in got if r.parent is None) and any(r.iqr_raw_flag for r in got)


def test_melt_and_pivot_are_inverse(spark):
    t = _panel(7, areas=4)
    long = _df(spark, t).withColumns({"area_name": F.upper("area"), "parent_name": F.upper("parent")})
    wide = reshape.final_wide(long, range(2011, 2017), "con")
    assert wide.columns == [*reshape.DEFAULT_IDS, *map(str, range(2011, 2017))]
    assert rows(reshape.wide_to_long(wide, "period", "con"), "area", "period", "con") == sorted((a, y, r["con"]) for (a, y), r in t.items())


def test_metric_columns_stand_in_order(spark):
    t = _panel(8, areas=2, years=(2011, 2012))
    df = _df(spark, t).select("area", F.lit("n").alias("flagged_name"), "parent", F.lit("p").alias("parent_name"), "period", "uncon", "con",
                              F.lit(True).alias("master_flag"))
    ids = ("area", "flagged_name", "parent", "parent_name")
    wide = reshape.metrics_wide(reshape.metrics_long(df, "uncon", "con", ids=ids), [2011, 2012], ids=ids)
    assert wide.columns == [*ids, "2011", "2012", "master_flag", "CONLSOA_2011", "CONLSOA_2012"]
    assert wide.count() == 2


def test_lookup_sums_by_target(spark):
    lookup = spark.createDataFrame([("T1", "East", f"S30{i}", f"u{i}") for i in (1, 2)] + [("T2", "West", "S303", "u3")],
                                   ", ".join(f"{c} string" for c in mapping.MAPPER_COLUMNS))
    data = spark.createDataFrame([(f"a{i}", f"S30{i % 4}", "n", 10.0 * i, None if i == 3 else 1.0) for i in range(8)],
                                 "area string, data_lau_code string, data_lau_name string, `2019` double, `2020` double")
    joined = mapping.join_mapper(data, mapping.clean_mapper(lookup)[0])
    assert rows(mapping.unmatched(joined), "area") == [("a0",), ("a4",)]
    got = rows(mapping.aggregate(joined, ["mapper_lad_code"]), "mapper_lad_code", "2019", "2020")
    assert got == [("T1", 10.0 + 20 + 50 + 60, 4.0), ("T2", 30.0 + 70, 1.0)]
