"""A parent holding a third of all rows: results do not depend on the partitioning."""

from pyspark.sql import functions as F

from panel_edit.operators import quantiles, reshape
from panel_edit.plans import catalog, jobs
from panel_edit.plans import fixtures as fx

SF = "/root/testdata/sf0.01"


def _rounded(df, digits=4):
    return sorted((tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def wide(panel, value):
    return panel.groupBy(*reshape.DEFAULT_IDS).agg(*reshape.pivot_cells("period", value, reshape.period_values(panel)))


def _run(spark, panel, decisions):
    # The hot parent mixes areas with and without copied-back periods, which the
    # rollback step rightly rejects (partial rollback); this test is about skew.
    start, end = fx.span(spark, SF)
    args = dict(start=start, end=end, rollback_start=1990, rollback_end=1990, ids=catalog.IDS)
    totals = fx.parent_totals(spark, SF)
    hot_totals = totals.where("parent <> 'HOT'")  # no total for the hot parent: its rows stay unconstrained
    e1 = jobs.preprocess(wide(panel, "uncon"), hot_totals, transaction=catalog.TRANSACTION, z_upper=2.0,
                         z_lower=-2.0, iqr_multiplier=1.0, **args)
    e2 = jobs.adjust(decisions, wide(panel, "con"), wide(panel, "uncon"), **args)
    cols = ["area", "period", "bkwd_zscore", "frwd_zscore", "raw_q1", "raw_q3", "iqr_raw_flag", "master_flag"]
    return _rounded(e1.interim.select(*cols), 6), _rounded(e1.output), _rounded(e2.output, 3)


def test_hot_parent_same_results_for_any_partitioning(spark):
    with fx.one_build():
        panel = fx.hot_parent_panel(spark, SF)
        assert panel.where("parent = 'HOT'").count() * 3 >= panel.count() - 7 * 3
        decisions = (fx.decisions(spark, SF).drop("parent", "parent_name")
                     .join(panel.select("area", "parent", "parent_name").distinct(), "area")
                     .select("area", "area_name", "parent", "parent_name", "adjust", "year"))
        few = _run(spark, panel, decisions)
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = _run(spark, panel, decisions)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for a, b in zip(few, many, strict=True):
        assert a == b
    assert len(few[0]) == 700 and len(few[2]) == 100


def test_quantiles_of_a_hot_group_equal_percentile(spark):
    df = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 50 AS STRING) END AS g",
                                       "CAST((id * 7919) % 10007 AS DOUBLE) AS v")
    single = _rounded(df.groupBy("g").agg(F.percentile("v", 0.25).alias("q1"), F.percentile("v", 0.75).alias("q3")), 9)
    spread = _rounded(quantiles.group_quantiles(df, ["g"], "v", {"q1": 0.25, "q3": 0.75}), 9)
    assert single == spread and len(single) == 51


def test_a_value_held_by_half_the_rows_makes_no_large_partition(spark):
    """400,000 rows, three groups, half the values 0.0."""
    df = spark.range(400000).selectExpr("CAST(id % 3 AS STRING) AS g", "CASE WHEN id % 2 = 0 THEN 0.0D ELSE CAST((id * 7919) % 100003 AS DOUBLE) END AS v")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        counted = quantiles.counted_values(df, ["g"], "v")
        sizes = [r[1] for r in counted.groupBy("_pid").count().collect()]
        assert len(sizes) == 16 and max(sizes) <= 3 * sum(sizes) / len(sizes)
        assert counted.agg(F.sum("_c")).first()[0] == 400000
        got = _rounded(quantiles.group_quantiles(df, ["g"], "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.77, "e": 1.0}), 9)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == _rounded(df.groupBy("g").agg(*[F.percentile("v", q).alias(n) for n, q in zip("abcde", (0.0, 0.25, 0.5, 0.77, 1.0))]), 9)


def test_quantiles_of_ties_single_values_and_gaps(spark):
    df = spark.createDataFrame([("a", 5.0)] * 7 + [("a", -1.0), ("a", None), ("b", 2.0), ("c", None), (None, 1.0), ("d", 1.0), ("d", 2.0), ("d", -0.0), ("d", 0.0)],
                               "g string, v double")
    got = _rounded(quantiles.group_quantiles(df, ["g"], "v", {"q1": 0.25, "q2": 0.9}), 9)
    want = df.where("g IS NOT NULL AND v IS NOT NULL").groupBy("g").agg(F.percentile("v", 0.25).alias("q1"), F.percentile("v", 0.9).alias("q2"))
    assert got == _rounded(want, 9) and len(got) == 3
