import os

import pytest

from panel_edit.operators import mapping
from panel_edit.plans import jobs
from panel_edit.session import scratch_path
from panel_edit.sources import csv, qa
from tests.conftest import rows


@pytest.mark.parametrize(
    "data,cols,need",
    [([("S301", "A1"), ("E102", "A2")], ["data_lau_code", "data_lau_name"], True),
     ([("E101", "A1"), ("E102", "A2")], ["parent", "parent_name"], False)],
)
def test_prefix_rename(spark, data, cols, need):
    df, flag = mapping.prefix_rename(spark.createDataFrame(data, "parent string, parent_name string"))
    assert flag is need and set(cols) <= set(df.columns)


def test_prefix_rename_without_column(spark):
    df, flag = mapping.prefix_rename(spark.createDataFrame([("x",)], "other string"))
    assert flag is False and df.columns == ["other"]


def _mapper(spark):
    return spark.createDataFrame(
        [("L1", "One", "S301", "u1", "x"), ("L1", "One", "S301", "u1", "y"), ("L2", "Two", "S302", "u2", "z")],
        "mapper_lad_code string, mapper_lad_name string, mapper_lau_code string, mapper_lau_name string, "
        "extra string")


def test_mapper_clean_join_aggregate_reformat(spark):
    clean, ok = mapping.clean_mapper(_mapper(spark))
    assert ok and clean.count() == 2 and len(clean.columns) == 4
    data = spark.createDataFrame(
        [("a", "S301", "n1", 1, 10), ("b", "S301", "n1", 2, 20), ("c", "S302", "n2", 3, None),
         ("d", "S399", "n9", 4, 40)],
        "area string, data_lau_code string, data_lau_name string, `2020` int, `2021` int")
    joined = mapping.join_mapper(data, clean)
    assert "data_lau_code" not in joined.columns
    assert rows(mapping.unmatched(joined), "area") == [("d",)]
    rolled = mapping.aggregate(joined, ["mapper_lad_code", "mapper_lad_name"])
    assert rows(rolled, "mapper_lad_code", "2020", "2021") == [("L1", 3, 30), ("L2", 3, 0)]
    parity = mapping.aggregate(joined)  # groups by every other column: stays per area, drops unmatched
    assert parity.count() == 3
    out = mapping.reformat(parity, ["area", "parent", "parent_name", "2020", "2021"])
    assert out.columns == ["area", "parent", "parent_name", "2020", "2021"]


def test_mapping_job_skips_without_unit_codes(spark):
    df = spark.createDataFrame([("a", "E01", "n", 1.0)], "area string, parent string, parent_name string, `2020` double")
    assert jobs.map_geography(df, _mapper(spark)).need_mapping is False


def test_csv_round_trip_with_schema(spark, tmp_path):
    df = spark.createDataFrame([("E1", 5, "keep", 1.5)], "`LSOA code` string, `Old col` string, "
                                                         "`Additional col` string, `2020` double")
    df = df.withColumn("Old col", df["Old col"].cast("string"))
    path = str(tmp_path / "io")
    csv.write_with_schema(df, path)
    schema = {"area": {"old_name": "LSOA code", "type": "str"}, "count": {"old_name": "Old col", "type": "int"}}
    back = csv.read_with_schema(spark, path, schema)
    assert back.columns == ["area", "count", "Additional col", "2020"]
    r = back.first()
    assert (r.area, r["count"], r["Additional col"], r["2020"]) == ("E1", 5, "keep", 1.5)
    with pytest.raises(ValueError, match="the data lacks"):
        csv.read_with_schema(spark, path, {"x": {"old_name": "missing", "type": "str"}})
    bad = spark.createDataFrame([("E1", "unknown")], "a string, b string")
    csv.write_with_schema(bad, path)
    with pytest.raises(TypeError):
        csv.read_with_schema(spark, path, {"b": {"old_name": "b", "type": "int"}})
    assert csv.read_with_schema(spark, path, {"b": {"old_name": "b", "type": "Int"}}).first().b == "unknown"


def test_csv_quotes_missing_cells_and_types(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('name,2010,n,ok\n"a ""b"", c",1,12.0,true\n"two\nlines",2,12.7,perhaps\nNA,3,N/A,false\n')
    schema = {"label": {"old_name": "name", "type": "str"}, "n": {"old_name": "n", "type": "int"}, "ok": {"old_name": "ok", "type": "bool"}}
    got = csv.read_with_schema(spark, str(path), schema, validate=False)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [
        ('a "b", c', 1.0, 12, True), ("two\nlines", 2.0, None, None), (None, 3.0, None, False)]
    report = {(r["column"], r["problem"], r["n"]) for r in csv.schema_report(
        got, {"label": {"type": "float"}, "n": {"type": "int"}, "ok": {"type": "bool"}, "gone": {"type": "str"}}).collect()}
    assert report == {("label", "type string", 0), ("n", "missing values", 2), ("gone", "no such column", 0)}
    with pytest.raises(TypeError, match="label: type string"):
        csv.schema_violations(got, {"label": {"type": "int"}})


def test_schema_from_toml(tmp_path):
    p = tmp_path / "s.toml"
    p.write_text('[area]\nold_name = "Area code"\nDeduced_Data_Type = "str"\n')
    assert csv.load_schema(str(p)) == {"area": {"old_name": "Area code", "type": "str"}}


def test_parameter_file(spark, tmp_path):
    params = qa.parameters_frame(spark, {"zscore_lower_threshold": -3.0, "transaction_name": "Income"})
    out = str(tmp_path / "qa")
    qa.write_parameters(params, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.startswith("part"))
    assert text.splitlines() == ["zscore_lower_threshold = -3.0", "transaction_name = Income"]


def test_scratch_path_is_under_checkpoint_folder(spark):
    assert "panel_edit_scratch" in scratch_path(spark, "x")
