"""Exact per-group quantiles (linear interpolation between order statistics).

``value at h = (n-1)*q``, interpolated between ranks ``floor(h)`` and
``ceil(h)`` - the definition used by pandas, ``percentile`` and
``quantile_cont``. ``approx_percentile`` is not equivalent and is not used.

Weighted order statistics, one plan at every size: rows are first counted by
(group, value), so a value that half of a group holds is one row from then on;
the distinct values are range-partitioned on (group, value), so that a group of
any size spreads over partitions and no key is split from its count. Running
counts - of the blocks (partition, group), then inside the few blocks that hold
a wanted rank - pick the values around each rank. The counted values are written
to the checkpoint folder first: a lost executor can't deal them out otherwise
than they were counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panel_edit.session import cut_lineage


def counted_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, ``_v``, its count ``_c``, ``_pid``): distinct values in ranges of (keys, value), written.

    NULL values and rows with a NULL key are left out.
    """
    keys = list(keys)
    x = df.select(*keys, F.col(value).cast("double").alias("_v")).dropna(subset=[*keys, "_v"])
    parts = int(x.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = x.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    return cut_lineage(counts.repartitionByRange(parts, *keys, "_v").withColumn("_pid", F.spark_partition_id()))


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
) -> DataFrame:
    """One row per group of ``keys`` with a column per entry of ``probs``.

    NULL values are skipped; groups with no value, and rows with a NULL key, are absent.
    """
    keys = list(keys)
    counted = counted_values(df, keys, value)
    group = Window.partitionBy(*keys)
    blocks = (counted.groupBy(*keys, "_pid").agg(F.sum("_c").alias("_b"))
              .withColumn("_before", F.sum("_b").over(group.orderBy("_pid")) - F.col("_b"))
              .withColumn("_n", F.sum("_b").over(group)))
    at = {name: (F.col("_n") - 1) * F.lit(float(q)) for name, q in probs.items()}

    def holds(rank, first, n):
        return (rank >= first) & (rank < first + n)

    wanted = [f(h) for h in at.values() for f in (F.floor, F.ceil)]
    blocks = blocks.where(reduce(lambda a, b: a | b, [holds(r, F.col("_before"), F.col("_b")) for r in wanted]))
    inside = Window.partitionBy(*keys, "_pid").orderBy("_v")
    x = counted.join(blocks, [*keys, "_pid"]).withColumn("_first", F.col("_before") + F.sum("_c").over(inside) - F.col("_c"))

    def value_at(rank):
        return F.max(F.when(holds(rank, F.col("_first"), F.col("_c")), F.col("_v")))

    picked = x.groupBy(*keys).agg(F.max("_n").alias("_n"), *[
        value_at(f(h)).alias(f"_{side}_{name}") for name, h in at.items() for side, f in (("low", F.floor), ("high", F.ceil))])

    def between(name, h):
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        return F.when(F.floor(h) == F.ceil(h), low).otherwise((F.ceil(h) - h) * low + (h - F.floor(h)) * high)

    return picked.select(*keys, *[between(name, h).alias(name) for name, h in at.items()])
