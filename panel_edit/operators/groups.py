"""Per-group statistics attached back to rows, by one plan at every size.

Statistics are decomposable (count, sum, min, avg, stddev), so
``groupBy().agg()`` combines map-side before the shuffle: a parent holding a
third of all rows costs one partial row per input partition, not one
overloaded task. The one-row-per-group result is joined back without a hint;
AQE broadcasts it by its measured bytes, and beyond that splits a hot key's
partition on the row side. A NULL key matches nothing, as in a group-by that
drops missing keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_group_stats(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Add columns ``name -> aggregate`` computed per ``keys`` to every row of ``df``.

    ``aggs`` are plain aggregate expressions (``F.sum(c)``, not aliased).
    Rows whose key contains NULL get NULL statistics.
    """
    keys = list(keys)
    stats = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()])
    return df.join(stats, on=keys, how="left")


def id_violations(areas: DataFrame, parent: str, area: str, ids: Sequence[str] | None = None) -> tuple[int, int]:
    """(rows without area or parent code, rows that repeat the identifiers ``ids``) of an area-level table, in one job."""
    ids = list(ids or [area])
    keys = ids if parent in ids else [parent, *ids]
    missing = (F.col(area).isNull() | F.col(parent).isNull()).cast("long")
    per_id = areas.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(missing).alias("_miss"))
    row = per_id.agg(F.sum("_miss").alias("x"), F.sum(F.col("_n") - 1).alias("d")).first()
    return row["x"] or 0, row["d"] or 0
