"""End to end: CSV files with their own headers + TOML config -> three stages -> CSV outputs."""

import os


from panel_edit.plans import catalog
from panel_edit.plans import fixtures as fx
from panel_edit.plans.pipeline import run_pipeline
from panel_edit.sources import csv
from tests.conftest import SF_SMALL

HEADERS = {"area": "Area code", "area_name": "Area name", "parent": "Parent code", "parent_name": "Parent name"}


def _toml_schema(path, mapping):
    with open(path, "w") as fh:
        for new, old in mapping.items():
            fh.write(f'["{new}"]\nold_name = "{old}"\nDeduced_Data_Type = "str"\n\n')


def test_run_pipeline_from_config(spark, tmp_path):
    d = str(tmp_path)
    out_schema = {h: {"old_name": n, "type": "str"} for n, h in HEADERS.items()}
    with fx.one_build():
        start, end = fx.span(spark, SF_SMALL)
        csv.write_with_schema(fx.wide(spark, SF_SMALL, "uncon"), f"{d}/uncon", out_schema)
        csv.write_with_schema(fx.wide(spark, SF_SMALL, "con"), f"{d}/con", out_schema)
        csv.write_with_schema(fx.decisions(spark, SF_SMALL), f"{d}/decisions", out_schema)
        csv.write_with_schema(fx.parent_totals(spark, SF_SMALL), f"{d}/totals")
        csv.write_with_schema(fx.lookup(spark, SF_SMALL), f"{d}/mapper")
        expected = catalog.QUERIES["e2_adjust"](spark, SF_SMALL).collect()
    _toml_schema(f"{d}/in.toml", {n: h for n, h in HEADERS.items()})
    _toml_schema(f"{d}/out.toml", {h: n for n, h in HEADERS.items()})
    config = {
        "user_settings": {
            "start_year": start, "end_year": end,
            "rollback_year_start": fx.ROLLBACK_START, "rollback_year_end": fx.ROLLBACK_END,
            "preprocessing": True, "adjustment": True, "mapping": True,
            "zscore_upper_threshold": 2.0, "zscore_lower_threshold": -2.0, "iqr_multiplier": 1.0,
            "transaction_name": catalog.TRANSACTION, "output_data": True, "output_data_prefix": "t",
        },
        "paths": {
            "schema_path": d, "panel": f"{d}/uncon", "panel_schema": "in.toml", "parent_totals": f"{d}/totals",
            "decisions": f"{d}/decisions", "decisions_schema": "in.toml", "constrained": f"{d}/con",
            "constrained_schema": "in.toml", "unconstrained": f"{d}/uncon", "unconstrained_schema": "in.toml",
            "mapper": f"{d}/mapper", "output_dir": f"{d}/out", "adjust_output_schema": "out.toml",
            "preprocess_output_schema": "out.toml", "mapping_output_schema": "out.toml",
        },
    }
    results = run_pipeline(spark, config)
    inputs = ("panel", "parent_totals", "decisions", "constrained", "unconstrained", "mapper")
    assert set(results) == {"preprocessing", "adjustment", "mapping", "mapping_unmatched_rows", "mapping_ambiguous_rows",
                            *(f"{n}_coercions" for n in inputs)}
    assert all(results[f"{n}_coercions"] == {} for n in inputs)
    written = sorted(os.listdir(f"{d}/out"))
    assert "t_adjustment_output" in written and "t_preprocessing_config" in written
    assert "t_mapping_output_not_aggregated" in written
    back = csv.read_with_schema(spark, f"{d}/out/t_adjustment_output", {n: {"old_name": h, "type": "str"}
                                                                        for n, h in HEADERS.items()})
    got = sorted(tuple(round(v, 3) if isinstance(v, float) else v for v in r) for r in back.collect())
    assert got == sorted(tuple(r) for r in expected)
    assert results["mapping_unmatched_rows"] == results["mapping"].unmatched.count() > 0
    assert spark.read.option("header", True).csv(f"{d}/out/t_mapping_unmatched").count() == results["mapping_unmatched_rows"]
