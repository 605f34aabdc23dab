"""Sharding by longest-processing-time scheduling.

Groups of equal texts stay together. Sorted by size, each goes to the least
loaded shard, kept in a heap. So that the heap's input is bounded at any
corpus size, a group is scheduled by itself when it holds more than
``1 / (shards * HEAVY)`` of all bytes (there are at most ``shards * HEAVY`` of
those); the others first fall by hash into bins whose expected sizes halve
from level to level, and the bins are scheduled in the same heap. The last
bins hold about ``2**-17`` of all bytes, which bounds how uneven the shards
end up unless a single group is larger than a shard.

Defined cases: null text has 0 bytes and is equal to the empty text; a
repeated row is placed like its twin, each with a slot of its own; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panel_edit.llm.common import keep

#: Groups above 1 / (shards * HEAVY) of all bytes are scheduled one by one.
HEAVY = 64
#: Bins of the other groups: BINS in each level, LEVELS levels, halving in size.
BINS, LEVELS = 512, 8
#: Rows that one slot-numbering bucket holds on average.
SLOT_ROWS = 10_000


def lpt(sizes: list[tuple], shards: int) -> dict:
    """``{unit: shard}`` for ``[(bytes, unit)]``: the largest first, to the least loaded shard."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for size, unit in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, s = heap[0]
        placed[unit] = s
        heapq.heapreplace(heap, (load + size, s))
    return placed


def _bin(key):
    """Bin of a group key: level l takes 2**-(l+1) of the hash space (the last takes the rest)."""
    h = F.xxhash64(key, F.lit("bin"))
    spread = F.shiftrightunsigned(h, 40)  # 24 bits
    level = F.lit(LEVELS - 1)
    for l in reversed(range(LEVELS - 1)):
        level = F.when(spread >= (1 << (23 - l)), F.lit(l)).otherwise(level)
    return (level * BINS + F.pmod(h, F.lit(BINS))).cast("int")


def shard_by_size(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = keep(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("key")))
    groups = keep(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("members")))
    total, members = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("members"), F.lit(0))).first()
    limit = total // (shards * HEAVY)
    heavy = groups.where(F.col("bytes") > limit).select("key", "bytes").collect()  # at most shards * HEAVY
    bins = groups.where(F.col("bytes") <= limit).groupBy(_bin(F.col("key")).alias("bin")).agg(F.sum("bytes").alias("bytes")).collect()
    placed = lpt([(r.bytes, (0, bytes(r.key))) for r in heavy] + [(r.bytes, (1, r.bin)) for r in bins], shards)
    own = spark.createDataFrame([(bytearray(u), s) for (kind, u), s in placed.items() if kind == 0] or [(None, 0)], "key binary, own_shard int")
    binned = spark.createDataFrame([(u, s) for (kind, u), s in placed.items() if kind == 1] or [(None, 0)], "bin int, bin_shard int")
    # Both sides of a proven size: shards * HEAVY and BINS * LEVELS rows.
    here = (rows.withColumn("bin", _bin(F.col("key"))).join(F.broadcast(own), "key", "left").join(F.broadcast(binned), "bin", "left")
            .select("doc_id", "size", "text_crc32", F.coalesce("own_shard", "bin_shard").alias("shard")))
    return _numbered(here, shards, members).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _numbered(rows: DataFrame, shards: int, members: int) -> DataFrame:
    """Add ``slot``: gapless from 0 in each shard, without one task per shard.

    Rows fall by hash into buckets; a bucket's first slot is the count of the
    rows in the shard's earlier buckets, and only rows of a bucket are sorted.
    """
    buckets = max(1, members // SLOT_ROWS // shards)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit("slot")), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("at", F.row_number().over(within) - 1).join(first, ["shard", "bucket"])
            .withColumn("slot", (F.col("first") + F.col("at")).cast("bigint")))
