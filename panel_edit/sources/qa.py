"""Parameter (QA) records written next to a job's outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def parameters_frame(spark: SparkSession, params: Mapping[str, object]) -> DataFrame:
    """One ``name = value`` line per parameter, in the given order, column ``config``."""
    lines = [(f"{k} = {v}",) for k, v in params.items()]
    return spark.createDataFrame(lines, "config string")


def write_parameters(df: DataFrame, path: str) -> None:
    """Write the parameter lines as one plain-text file (no header)."""
    df.coalesce(1).write.mode("overwrite").text(path)
