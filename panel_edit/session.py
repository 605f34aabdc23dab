"""Session helpers: builder defaults, checkpoint directory, lineage cuts, columnar interim tables."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(
    app_name: str = "panel_edit",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators are tuned for.

    AQE is on so that small shuffles are coalesced and hot partitions of a
    join are split at run time; the UI is off (no server is opened).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Checkpoint files of frames no longer referenced are removed.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Local mode runs every task inside the driver JVM.
        "spark.driver.memory": os.environ.get("PANEL_EDIT_DRIVER_MEMORY", "4g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder; set ``fallback`` only when unset (tests)."""
    found = checkpoint_dir(spark)
    if found:
        return found
    os.makedirs(fallback, exist_ok=True)
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder on storage that all executors share.

    A cluster must name one (``spark.checkpoint.dir``). A session on one
    machine, as in tests, gets a folder of its own where none is named.
    """
    found = checkpoint_dir(spark)
    if found:
        return found
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="panel-edit-ckpt-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate files, under the shared checkpoint folder."""
    import uuid

    return f"{shared_dir(spark).rstrip('/')}/panel_edit_scratch/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of :func:`scratch_path` through Spark's file system layer."""
    if "/panel_edit_scratch/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder: later stages don't recompute it, and a lost executor loses none of it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_lineage_counting(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """:func:`cut_lineage`, and how many rows meet each condition: counted while the rows are written, in the same job."""
    if not counts:
        return cut_lineage(df), {}
    seen, names = Observation(), list(counts)
    out = cut_lineage(df.observe(seen, *[F.count_if(counts[n]).alias(f"_{i}") for i, n in enumerate(names)]))
    found = seen.get
    return out, {n: found.get(f"_{i}") or 0 for i, n in enumerate(names)}


_LEFT: list[tuple[SparkSession, str]] = []


def _remove_left() -> None:
    for spark, path in _LEFT:
        try:
            remove_path(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone already, and its files with it
            pass


def columnar(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: later steps read only the columns they use.

    The files go when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if not _LEFT:
        atexit.register(_remove_left)
    _LEFT.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)
