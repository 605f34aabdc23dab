import math

import numpy as np
import pytest

from panel_edit.operators import outliers
from panel_edit.operators.quantiles import group_quantiles
from tests.conftest import rows


def _scores(spark):
    vals = [1.0, 1.1, 0.9, 1.05, 0.95, 1.02, 0.98, 1.01, 0.99, 1.03, 9.0]
    data = [("p1", f"a{i}", 2000 + i, v, False) for i, v in enumerate(vals)]
    data += [("p2", "b0", 2000, 5.0, True), ("p2", "b1", 2001, None, False)]
    return spark.createDataFrame(data, "parent string, area string, period int, x double, rollback_flag boolean")


def test_zscore_matches_numpy_and_flags_outlier(spark):
    out = outliers.zscores(_scores(spark), "bkwd", "parent", "x", 2.5, -2.5)
    got = {r.area: r for r in out.collect()}
    vals = np.array([1.0, 1.1, 0.9, 1.05, 0.95, 1.02, 0.98, 1.01, 0.99, 1.03, 9.0])
    z = (vals - vals.mean()) / vals.std(ddof=1)
    assert math.isclose(got["a10"].bkwd_zscore, z[-1], rel_tol=1e-12)
    assert got["a10"].z_bkwd_flag and got["a10"].bkwd_zscore_threshold == "upper"
    assert not got["a0"].z_bkwd_flag and got["a0"].bkwd_zscore_threshold is None
    # Rollback rows and all-missing groups get no score and no flag.
    assert got["b0"].bkwd_zscore is None and got["b0"].z_bkwd_flag is False
    assert got["b1"].bkwd_zscore is None


def test_zscore_constant_group_is_unscored(spark):
    df = spark.createDataFrame([("p", 1.0, False), ("p", 1.0, False)], "parent string, x double, rollback_flag boolean")
    assert [r.bkwd_zscore for r in outliers.zscores(df, "bkwd", "parent", "x").collect()] == [None, None]


def test_quantiles_linear_like_numpy(spark):
    vals = [1.0, 2.0, 4.0, 7.0, 11.0, 16.0]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v double")
    q = group_quantiles(df, ["g"], "v", {"q1": 0.25, "q3": 0.75}).first()
    assert (q.q1, q.q3) == (np.quantile(vals, 0.25), np.quantile(vals, 0.75)) == (2.5, 10.0)


def test_quantiles_equal_numpy_with_one_large_group(spark):
    rng = np.random.default_rng(7)
    data = {f"g{k}": rng.integers(0, 1000, size=int(50 + 100 * k)).astype(float) for k in range(3)}
    data["hot"] = rng.normal(size=2000)
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs], "g string, v double")
    probs = {"q1": 0.25, "med": 0.5, "q3": 0.75, "top": 1.0}
    got = group_quantiles(df, ["g"], "v", probs).collect()
    assert len(got) == 4
    for r in got:
        for name, q in probs.items():
            assert math.isclose(r[name], np.quantile(data[r.g], q), rel_tol=1e-12, abs_tol=1e-12)


def test_iqr_fences_exclude_rollback_from_quartiles_but_test_every_row(spark):
    data = [("p", 2000, v, False) for v in [10.0, 11.0, 12.0, 13.0, 14.0]] + [("p", 2000, 100.0, True),
                                                                             ("p", 2000, 40.0, False)]
    df = spark.createDataFrame(data, "parent string, period int, uncon double, rollback_flag boolean")
    out = outliers.iqr_fences(df, "raw", ["parent", "period"], "uncon", multiplier=1.5)
    got = {r.uncon: r for r in out.collect()}
    # Quartiles of 10..14 and 40: 11.25 / 13.75, iqr 2.5, fences 7.5 / 17.5.
    assert got[10.0].raw_q1 == 11.25 and got[10.0].raw_q3 == 13.75
    assert got[100.0].iqr_raw_flag and got[100.0].raw_iqr_threshold == "upper"
    assert got[40.0].iqr_raw_flag and not got[12.0].iqr_raw_flag


def test_master_flag_is_and_of_detectors_over_all_periods(spark):
    df = spark.createDataFrame(
        [("a", 1, True, False, True), ("a", 2, False, False, False), ("b", 1, True, False, False),
         ("c", 1, False, False, True)],
        "area string, period int, z_bkwd_flag boolean, z_frwd_flag boolean, iqr_raw_flag boolean")
    out = outliers.master_flag(df)
    assert rows(out, "area", "period", "master_flag") == [
        ("a", 1, True), ("a", 2, True), ("b", 1, False), ("c", 1, False)]
    z_only = outliers.master_flag(df.drop("iqr_raw_flag"), zscore=True, iqr=False)
    assert rows(z_only, "area", "master_flag")[:3] == [("a", True), ("a", True), ("b", True)]
    with pytest.raises(ValueError):
        outliers.master_flag(df, zscore=False, iqr=False)
