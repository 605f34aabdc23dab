"""Run the three stages from one TOML (or dict) configuration, reading and writing CSV.

Configuration (keys of ``[user_settings]`` as in a stage-switch config)::

    [user_settings]
    start_year = 2010            end_year = 2023
    rollback_year_start = 2010   rollback_year_end = 2014
    preprocessing = true         adjustment = true         mapping = true
    zscore_calculation = true    iqr_calculation = true
    zscore_lower_threshold = -3.0  zscore_upper_threshold = 3.0
    iqr_lower_quantile = 0.25    iqr_upper_quantile = 0.75  iqr_multiplier = 1.0
    transaction_name = "..."     accept_negatives = false
    output_data = true           output_data_prefix = "run"
    aggregate_to_parent = false

    [columns]      # internal names after the input schemas' renames
    area = "lsoa_code"  area_name = "lsoa_name"  parent = "lad_code"  parent_name = "lad_name"
    transaction = "transaction_name"
    total_descriptors = ["Region", "Region name", "Transaction code", "transaction_name"]

    [paths]        # files or folders; schemas relative to schema_path
    schema_path = "config/schemas/"
    panel = "..."  panel_schema = "..."   parent_totals = "..."  parent_totals_schema = "..."
    decisions = "..."  decisions_schema = "..."  constrained = "..."  constrained_schema = "..."
    unconstrained = "..."  unconstrained_schema = "..."
    mapping_input = "..."  mapping_input_schema = "..."  mapper = "..."  mapper_schema = "..."
    output_dir = "..."
    preprocess_output_schema = "..."  adjust_output_schema = "..."  mapping_output_schema = "..."

The names of the keys above are fixed values: those of existing configuration files.
Each input also gives ``<prefix>_<input>_coercions``: the cells that its schema's
types could not hold, by column and text. Unlike a switchboard that logs and swallows errors, a failing stage raises.
Each written output is a folder of CSV part files (``single_file = true``
in ``[paths]`` coalesces small outputs to one part).
"""

from __future__ import annotations

import os
import tomllib
import warnings
from collections.abc import Mapping

from pyspark.sql import SparkSession

from panel_edit.operators import constrain
from panel_edit.plans import jobs
from panel_edit.session import cut_lineage
from panel_edit.sources import csv, qa


def load_config(config: Mapping | str) -> dict:
    if isinstance(config, str):
        with open(config, "rb") as fh:
            return tomllib.load(fh)
    return dict(config)


def _schema(paths: Mapping, key: str):
    name = paths.get(key)
    if not name:
        return None
    return csv.load_schema(os.path.join(paths.get("schema_path", ""), name))


def run_pipeline(spark: SparkSession, config: Mapping | str) -> dict:
    """Run the enabled stages; returns the job results by stage name."""
    cfg = load_config(config)
    us, paths, cols = cfg["user_settings"], cfg.get("paths", {}), cfg.get("columns", {})
    ids = tuple(cols.get(k, k) for k in ("area", "area_name", "parent", "parent_name"))
    start, end = us["start_year"], us["end_year"]
    prefix = us.get("output_data_prefix", "run")
    out_dir = paths.get("output_dir", "")
    single = bool(paths.get("single_file", False))
    write = bool(us.get("output_data", True))

    def target(name: str) -> str:
        return os.path.join(out_dir, f"{prefix}_{name}")

    results: dict = {}

    def read(name: str, period_type: str | None = "double"):
        """One input file. Cells that its schema's types can't hold become NULL; they are written, counted and warned of."""
        schema = _schema(paths, f"{name}_schema") or {}
        found = csv.read_with_ledger(spark, paths[name], schema, period_type)
        csv.write_with_schema(found.ledger.orderBy("column", "value"), target(f"{name}_coercions"), single_file=single)
        results[f"{name}_coercions"] = found.lost
        if found.lost:
            warnings.warn(f"{name}: cells set to NULL since they do not parse, by column: {found.lost}", stacklevel=3)
        csv.schema_violations(found.frame, schema, found.missing)
        return found.frame

    if us.get("preprocessing"):
        panel = read("panel")
        totals = read("parent_totals", period_type=None)  # may hold thousands separators
        r = jobs.preprocess(
            panel, totals, start=start, end=end,
            rollback_start=us["rollback_year_start"], rollback_end=us["rollback_year_end"],
            transaction=us["transaction_name"], zscore=us.get("zscore_calculation", True),
            iqr=us.get("iqr_calculation", True),
            z_upper=us.get("zscore_upper_threshold", 3.0), z_lower=us.get("zscore_lower_threshold", -3.0),
            iqr_lower_quantile=us.get("iqr_lower_quantile", 0.25),
            iqr_upper_quantile=us.get("iqr_upper_quantile", 0.75),
            iqr_multiplier=us.get("iqr_multiplier", 3.0), ids=ids,
            transaction_col=cols.get("transaction", "transaction"),
            total_descriptors=tuple(cols.get("total_descriptors", constrain.TOTAL_DESCRIPTORS)),
        )
        qa.write_parameters(r.parameters, target("preprocessing_config"))
        csv.write_with_schema(r.interim, target("preprocessing_interim"), single_file=single)
        if write:
            csv.write_with_schema(r.output, target("preprocessing_output"),
                                  _schema(paths, "preprocess_output_schema"), single_file=single)
        results["preprocessing"] = r

    adjusted = None
    if us.get("adjustment"):
        decisions, con, uncon = read("decisions"), read("constrained"), read("unconstrained")
        filters = {k: us.get(k) for k in ("sas_code_filter", "cord_code_filter", "credit_debit_filter")}
        r = jobs.adjust(
            decisions, con, uncon, start=start, end=end,
            rollback_start=us["rollback_year_start"], rollback_end=us["rollback_year_end"],
            accept_negatives=us.get("accept_negatives", False), ids=ids, component_filters=filters,
        )
        qa.write_parameters(r.parameters, target("adjustment_config"))
        csv.write_with_schema(r.interim.drop("year_to_adjust"), target("adjustment_interim"), single_file=single)
        if write:
            # Files list areas in identifier order (export only: one range-partitioned sort).
            csv.write_with_schema(r.output.orderBy(*ids), target("adjustment_output"),
                                  _schema(paths, "adjust_output_schema"), single_file=single)
        adjusted = r.output
        results["adjustment"] = r

    if us.get("mapping"):
        if adjusted is None:
            adjusted = read("mapping_input")
        mapper = read("mapper")
        aggregate = bool(us.get("aggregate_to_parent", us.get("aggregate_to_lad", False)))
        r = jobs.map_geography(adjusted, mapper, aggregate=aggregate, code_col=ids[2], name_col=ids[3])
        if r.need_mapping:
            # What the lookup left out or multiplied is written and counted, never dropped silently.
            for name, frame in (("mapping_unmatched", r.unmatched), ("mapping_ambiguous", r.ambiguous)):
                frame = cut_lineage(frame)  # written and counted from one run of the join
                csv.write_with_schema(frame, target(name), single_file=single)
                results[f"{name}_rows"] = frame.count()
        if r.need_mapping and write:
            name = "mapping_output_aggregated" if aggregate else "mapping_output_not_aggregated"
            csv.write_with_schema(r.output.orderBy(*[c for c in ids if c in r.output.columns]), target(name),
                                  _schema(paths, "mapping_output_schema"), single_file=single)
        results["mapping"] = r
    return results
