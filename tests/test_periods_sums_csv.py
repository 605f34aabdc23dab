"""Periods come from the data, sums don't depend on partitions, CSV files are split where they can be, and lost cells are recorded."""

import os

import pytest
from pyspark.sql import functions as F

from panel_edit.operators import checks, reshape
from panel_edit.operators.sums import exact_sum
from panel_edit.plans import catalog, jobs
from panel_edit.plans import fixtures as fx
from panel_edit.plans.pipeline import run_pipeline
from panel_edit.sources import csv
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def later_tables(spark, tmp_path_factory):
    """The small tables with a third of the shipments moved twelve years on, into years the given tables lack."""
    folder = str(tmp_path_factory.mktemp("later"))
    for name in ("supplier", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    moved = F.when(F.col("l_orderkey") % 3 == 0, F.add_months("l_shipdate", 144)).otherwise(F.col("l_shipdate"))
    li.withColumn("l_shipdate", moved).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_a_year_outside_the_given_ones_survives(spark, later_tables):
    with fx.one_build():
        years = fx.years(spark, later_tables)
    assert years[0] <= 1995 and years[-1] > 2005
    last = str(years[-1])
    for name in ("r5_final_wide", "d6_union_sorted", "j1_decision_con", "j2_decision_uncon", "e1_preprocess", "e2_adjust", "e3_mapping", "j13_mapper_join", "a10_rollup"):
        got = catalog.QUERIES[name](spark, later_tables)
        assert any(c.endswith(last) for c in got.columns), name
    for name in ("r1_wide_to_long", "r4_adjust_long", "d11_apportion"):
        got = catalog.QUERIES[name](spark, later_tables)
        assert got.where(F.col("period") == int(last)).count() > 0, name
    wide = catalog.QUERIES["e2_adjust"](spark, later_tables)
    assert wide.where(F.col(f"`{last}`").isNotNull()).count() > 0


def test_period_values(spark):
    df = spark.createDataFrame([(2003,), (1999,), (None,), (2003,)], "period int")
    assert reshape.period_values(df) == [1999, 2003]
    assert reshape.period_values(df.limit(0)) == []
    with pytest.raises(ValueError, match="more than 1 periods"):
        reshape.period_values(df, limit=1)
    wide = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "area int, `2003` double, `1999` double, `2010` double")
    assert reshape.periods_within(wide, 1999, 2005) == [1999, 2003]


def test_a_job_keeps_the_periods_its_input_has(spark):
    """Columns 2001, 2002 and 2004: no column for 2003 appears, and none is lost."""
    wide = spark.createDataFrame([(f"a{i}", "n", "P", "pn", 1.0 * i, 2.0 * i, 3.0 * i) for i in range(1, 5)],
                                 "area string, area_name string, parent string, parent_name string, `2001` double, `2002` double, `2004` double")
    dec = spark.createDataFrame([("a1", "n", "P", "pn", "TRUE", "2002")], "area string, area_name string, parent string, parent_name string, adjust string, year string")
    out = jobs.adjust(dec, wide, wide, start=2001, end=2004, rollback_start=1990, rollback_end=1990).output
    assert reshape.period_columns(out) == ["2001", "2002", "2004"]


def test_sums_are_the_same_under_any_partitioning(spark):
    df = spark.range(20000).selectExpr("CAST(id % 3 AS STRING) AS g", "CAST((id * 7919) % 100003 AS DOUBLE) / 7 * IF(id % 2 = 0, 1e6, 1e-3) AS v")
    def sums(n, agg):
        return [r[1] for r in df.repartition(n, "v").groupBy("g").agg(agg.alias("s")).orderBy("g").collect()]
    assert sums(1, exact_sum("v")) == sums(200, exact_sum("v"))
    plain = sums(1, F.sum("v"))
    assert all(abs(a - b) <= 1e-9 * abs(b) for a, b in zip(sums(7, exact_sum("v")), plain))


def test_sums_of_nothing_and_of_values_beyond_a_decimal(spark):
    df = spark.createDataFrame([("none", None), ("big", 1e25), ("big", 1.0), ("small", 0.1), ("small", 0.2), ("nan", float("nan")), ("nan", 1.0)], "g string, v double")
    got = dict(rows(df.groupBy("g").agg(exact_sum("v").alias("s")), "g", "s"))
    assert got["none"] is None and got["big"] == 1e25 + 1.0 and got["small"] == 0.3 and got["nan"] != got["nan"]


def test_sum_check_finds_what_an_absolute_tolerance_must(spark):
    df = spark.createDataFrame([("P", 1, 1e9 + 0.1, 1e9), ("P", 1, 0.2, 0.3 + 2e-6), ("Q", 1, 0.1, 0.3), ("Q", 1, 0.2, 0.0)], "parent string, period int, a double, b double")
    bad = checks.sum_mismatches(df.repartition(5), ["parent", "period"], "a", "b", 1e-6)
    assert rows(bad, "parent") == [("P",)]


def _write(path, text):
    with open(path, "w", newline="") as fh:
        fh.write(text)
    return str(path)


def test_a_large_plain_file_is_read_in_many_tasks(spark, tmp_path):
    plain = _write(tmp_path / "plain.csv", "area,2001\n" + "".join(f'"a ""{i}"", x",{i}.5\n' for i in range(60000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        assert not csv.spans_lines(spark, plain)
        df = csv.read_with_schema(spark, plain, {"area": {"old_name": "area", "type": "str"}})
        assert df.rdd.getNumPartitions() >= 8
        assert df.count() == 60000 and df.agg(F.sum("2001")).first()[0] == sum(i + 0.5 for i in range(60000))
        broken = _write(tmp_path / "broken.csv", 'area,2001\nplain,1\n"two\nlines, ""and"" quotes",2\n')
        assert csv.spans_lines(spark, broken)
        assert rows(csv.read_with_schema(spark, broken, {}), "area", "2001") == [("plain", 1.0), ('two\nlines, "and" quotes', 2.0)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ledger_of_cells_that_do_not_parse(spark, tmp_path):
    path = _write(tmp_path / "in.csv", "k,i,f,b,t,2001\n1,12.0,1.5,true,x,7\n2,12.5,\"1,5\",maybe,y,seven\n3,abc,n/a,false,,\n4,12.5,2,TRUE,z,8\n")
    schema = {n: {"old_name": n, "type": t} for n, t in (("k", "int"), ("i", "int"), ("f", "float"), ("b", "bool"), ("t", "str"))}
    got = csv.read_with_ledger(spark, path, schema)
    df, ledger = got.frame, got.ledger
    assert got.lost == {"2001": 1, "b": 1, "f": 1, "i": 3} and got.missing == {"k": 0, "i": 3}
    assert sorted(map(tuple, ledger.collect())) == [("2001", "seven", 1), ("b", "maybe", 1), ("f", "1,5", 1), ("i", "12.5", 2), ("i", "abc", 1)]
    assert df.columns == ["k", "i", "f", "b", "t", "2001"]
    assert rows(df, "k", "i", "f", "b", "2001") == [(1, 12, 1.5, True, 7.0), (2, None, None, None, None), (3, None, None, False, None), (4, None, 2.0, True, 8.0)]
    same = csv.read_with_schema(spark, path, schema, validate=False)
    assert sorted(map(str, same.collect())) == sorted(map(str, df.collect()))
    none = csv.read_with_ledger(spark, path, {}, period_type=None)
    assert none.ledger.count() == 0 and none.frame.count() == 4 and none.lost == {}


def test_validation_rides_along_with_the_conversion(spark, tmp_path):
    """As many jobs with validation as without; the message names what the written rows lack."""
    path = _write(tmp_path / "in.csv", "k,i\n1,2\n3,x\n")
    schema = {"k": {"old_name": "k", "type": "int"}, "t": {"old_name": "i", "type": "str"}}
    sc, jobs_run = spark.sparkContext, []
    for validate in (False, True):
        sc.setJobGroup(f"read {validate}", "count jobs")
        csv.read_with_ledger(spark, path, schema, validate=validate)
        jobs_run.append(len(sc.statusTracker().getJobIdsForGroup(f"read {validate}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs_run[0] == jobs_run[1] > 0
    with pytest.raises(TypeError, match=r"i: missing values \(1\), declared int"):
        csv.read_with_ledger(spark, path, {"i": {"old_name": "i", "type": "int"}}, validate=True)


def test_later_steps_of_a_job_read_only_their_columns(spark):
    """The interim table is columnar: the parent means read five columns of it, a count of flags one."""
    import re

    with fx.one_build():
        interim = catalog.preprocess_job(spark, SF_SMALL).interim
    assert len(interim.columns) > 20

    def read(df):
        return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan().toString())[1]))

    means = interim.groupBy("parent", "period").agg(F.avg("uncon"))
    assert read(means) == {"parent", "period", "uncon"}
    assert read(interim.where("master_flag").select("area")) == {"area", "master_flag"}


def test_the_pipeline_warns_of_lost_cells_and_writes_them(spark, tmp_path):
    panel = "Area,area_name,parent,parent_name,2001,2002\na1,n,P,pn,1,2\na2,n,P,pn,n. a.,4\na3,n,P,pn,5,6\n"
    _write(tmp_path / "uncon.csv", panel)
    _write(tmp_path / "con.csv", panel.replace("n. a.", "3"))
    _write(tmp_path / "dec.csv", "area,area_name,parent,parent_name,adjust,year\na1,n,P,pn,FALSE,2001\n")
    _write(tmp_path / "in.toml", '[area]\nold_name = "Area"\nDeduced_Data_Type = "str"\n')
    config = {"user_settings": {"start_year": 2001, "end_year": 2002, "rollback_year_start": 1990, "rollback_year_end": 1990, "adjustment": True},
              "paths": {"schema_path": str(tmp_path), "decisions": str(tmp_path / "dec.csv"), "constrained": str(tmp_path / "con.csv"), "constrained_schema": "in.toml",
                        "unconstrained": str(tmp_path / "uncon.csv"), "unconstrained_schema": "in.toml", "output_dir": str(tmp_path / "out")}}
    with pytest.warns(UserWarning, match=r"unconstrained: cells set to NULL .*\{'2001': 1\}"):
        results = run_pipeline(spark, config)
    assert results["unconstrained_coercions"] == {"2001": 1} and results["constrained_coercions"] == {}
    written = spark.read.option("header", True).csv(os.path.join(str(tmp_path), "out", "run_unconstrained_coercions"))
    assert rows(written, "column", "value", "n") == [("2001", "n. a.", "1")]
