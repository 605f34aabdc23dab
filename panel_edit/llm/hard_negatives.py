"""Hard-negative mining over an STR-packed R-tree.

Rows (id, label, vector of whole numbers) are packed sort-tile-recursive: a range
partitioning on label, slab of the first coordinate and second coordinate, then
runs of ``TILE_ROWS`` rows; inside a tile two more coordinates are cut the same
way into leaves of ``LEAF`` rows, and boxes of ``FANOUT`` leaves above them. A
tile is one row of the index table. The order ends in the id, so no coordinate
or vector, however common, makes a tile larger than another.

A minimum bounding box gives each coordinate an interval, and so an interval for
the inner product with an anchor (and one of labels). Each task searches its
tiles for every anchor of a block with one best-first queue per anchor over the
upper ends of those intervals. A box is dropped only where it lies outside every
score window of the anchor or strictly below the k-th score that each of them
has, or where its labels can't fit; so the result is exact, ties included. The
k best of each task meet in a window per anchor.

Two searches run per block: positives (same label, no window), then negatives
(another label, a window per positive score). Anchors are taken in blocks of
``BLOCK`` rows, in the order of their ids, and broadcast: a block has a fixed
size, whatever the table's. Coordinates and slab bounds are chosen on the
``SAMPLE`` rows that come first by a hash of their ids; every row is indexed.

Scores are exact: products are summed in double precision where they stay below
2**53, and as Python's whole numbers beyond. A score that no 64-bit number holds
raises an OverflowError when it is returned.

Defined cases: rows with a null id or label, a null vector, or a component that
is null or not finite take no part; of rows that share an id, the one with the
least label, then the least vector, does; a vector shorter than another counts
as zero beyond its end; ties go by id; an anchor without positives or negatives
gives no rows; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panel_edit.llm.common import keep, remove, scratch, ship

#: Rows of a tile, of a leaf, and leaves below a box.
TILE_ROWS, LEAF, FANOUT = 2048, 64, 8
#: Anchors broadcast at once; rows that coordinates are chosen on; slabs of the first coordinate.
BLOCK, SAMPLE, SLABS = 2048, 4096, 8
#: Positives of an anchor, negatives of a positive, and the window of a negative's score in hundredths of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100

INDEX = "ids binary, labels binary, vectors binary, dim int"
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def valid_rows(table: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part: labels moved on, components in whole 256ths (as doubles)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    label = F.col("label").cast("bigint")
    rows = table.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                       F.transform("embedding", lambda x: x.cast("double") * 256.0).alias("vector"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector")


def matrix(vectors: list, dim: int) -> np.ndarray:
    """Rows of whole numbers, zero beyond the end of a shorter vector."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return np.floor(out)


def str_order(vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray, leaf: int) -> np.ndarray:
    """Sort-tile-recursive order of a tile: slabs of (label, widest coordinate), each sorted by the second widest."""
    wide = np.argsort(-np.ptp(vectors, axis=0), kind="stable")[:2] if vectors.shape[1] else []
    first = vectors[:, wide[0]] if len(wide) else ids
    second = vectors[:, wide[-1]] if len(wide) else ids
    order = np.lexsort((ids, first, labels))
    slab = leaf * int(np.ceil(np.sqrt(np.ceil(len(ids) / leaf))))
    return np.concatenate([part[np.lexsort((ids[part], second[part], labels[part]))] for part in np.split(order, range(slab, len(order), slab))])


def pack(batches: Iterator[pa.RecordBatch], tile: int, leaf: int) -> Iterator[pa.RecordBatch]:
    """Tiles of consecutive rows (vec_id, label, vector)."""
    held: list = []

    def packed(rows):
        dim = max(len(v) for _, _, v in rows)
        ids, labels = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
        vectors = matrix([v for _, _, v in rows], dim)
        order = str_order(vectors, labels, ids, leaf)
        small = vectors[order].astype("<i4") if vectors.size == 0 or np.abs(vectors).max() < 2**31 else vectors[order].astype("<f8")
        return pa.RecordBatch.from_pylist([{"ids": ids[order].tobytes(), "labels": labels[order].tobytes(), "vectors": small.tobytes(), "dim": dim}],
                                          pa.schema([("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("dim", pa.int32())]))

    for batch in batches:
        vectors = batch["vector"]
        for i, row in enumerate(zip(batch["vec_id"].to_pylist(), batch["label"].to_pylist(), strict=True)):
            held.append((*row, vectors[i].values.to_numpy(zero_copy_only=False)))
            if len(held) == tile:
                yield packed(held)
                held = []
    if held:
        yield packed(held)


class Tree:
    """One tile: its rows, and bounding boxes of its leaves, of runs of leaves, and of all."""

    def __init__(self, ids: bytes, labels: bytes, vectors: bytes, dim: int, width: int, leaf: int, fanout: int):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        n = len(self.ids)
        own = np.frombuffer(vectors, "<i4" if len(vectors) == 4 * n * dim else "<f8").reshape(n, dim)
        self.vectors = np.zeros((n, max(width, dim)))
        self.vectors[:, :dim] = own
        self.vectors = exact(self.vectors)
        #: (first child, end of children, least and greatest label, low and high corner) per level, leaves first.
        cut = np.arange(0, n, leaf)
        level = (cut, np.append(cut[1:], n), np.minimum.reduceat(self.labels, cut), np.maximum.reduceat(self.labels, cut),
                 np.minimum.reduceat(self.vectors, cut), np.maximum.reduceat(self.vectors, cut))
        self.levels = [level]
        while len(level[0]) > 1:
            m = len(level[0])
            cut = np.arange(0, m, fanout if m > fanout else m)
            level = (cut, np.append(cut[1:], m), np.minimum.reduceat(level[2], cut), np.maximum.reduceat(level[3], cut),
                     np.minimum.reduceat(level[4], cut), np.maximum.reduceat(level[5], cut))
            self.levels.append(level)


def exact(values: np.ndarray) -> np.ndarray:
    """The values as doubles where any sum of their products is exact, else as Python's whole numbers."""
    if values.dtype == object or not values.size or np.abs(values).max() ** 2 * values.shape[-1] < 2.0**52:
        return values
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


class Anchor:
    """One anchor's search: its score windows, and the best of each so far."""

    def __init__(self, vec_id: int, label: int, vector: np.ndarray, same: bool, windows: list, k: int):
        self.vec_id, self.label, self.vector, self.same, self.windows, self.k = vec_id, label, vector, same, windows, k
        self.up, self.down = np.maximum(vector, 0), np.minimum(vector, 0)
        self.best: list[list] = [[] for _ in windows]  # (-score, id), ascending

    def floor(self, w: int):
        """The least score that can still enter window w."""
        low = self.windows[w][0]
        return low if len(self.best[w]) < self.k else max(low, -self.best[w][-1][0])

    def bounds(self, level, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Greatest and least inner product that boxes i to j of a level can hold."""
        low, high = level[4][i:j, :len(self.vector)], level[5][i:j, :len(self.vector)]
        return high @ self.up + low @ self.down, low @ self.up + high @ self.down

    def fits(self, most, least, low_label, high_label) -> bool:
        if not low_label <= self.label <= high_label if self.same else low_label == high_label == self.label:
            return False
        return any(most >= self.floor(w) and least <= top for w, (_, top) in enumerate(self.windows))

    def visit(self, tree: Tree, i: int, j: int) -> None:
        """Rows i to j of a leaf."""
        scores = tree.vectors[i:j, :len(self.vector)] @ self.vector
        ok = (tree.labels[i:j] == self.label) == self.same
        if self.same:
            ok &= tree.ids[i:j] != self.vec_id
        for w, (_, top) in enumerate(self.windows):
            hit = np.flatnonzero(ok & (scores >= self.floor(w)) & (scores <= top))
            if len(hit):
                self.best[w] = heapq.nsmallest(self.k, [*self.best[w], *((-int(scores[x]), int(tree.ids[i + x])) for x in hit)])

    def search(self, trees: list[Tree]) -> None:
        """Best first over all boxes of the trees."""
        queue = []

        def push(t: int, depth: int, i: int, j: int) -> None:
            level = trees[t].levels[depth]
            most, least = self.bounds(level, i, j)
            for x in range(i, j):
                if self.fits(most[x - i], least[x - i], level[2][x], level[3][x]):
                    heapq.heappush(queue, (-most[x - i], t, depth, x, least[x - i]))

        for t, tree in enumerate(trees):
            push(t, len(tree.levels) - 1, 0, 1)
        while queue:
            most, t, depth, x, least = heapq.heappop(queue)
            level = trees[t].levels[depth]
            if -most < min(self.floor(w) for w in range(len(self.windows))):
                break  # nothing that is left reaches any window
            if not self.fits(-most, least, level[2][x], level[3][x]):
                continue
            if depth:
                push(t, depth - 1, int(level[0][x]), int(level[1][x]))
            else:
                self.visit(trees[t], int(level[0][x]), int(level[1][x]))


def searched(block, same: bool, k: int):
    """For ``mapInArrow`` over the index: the k best of each anchor and window in the task's tiles."""
    leaf, fanout = LEAF, FANOUT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, windows = block.value
        vectors = exact(vectors)
        anchors = [Anchor(i, y, v, same, w, k) for i, y, v, w in zip(ids, labels, vectors, windows, strict=True) if w]
        for batch in batches:
            trees = [Tree(r["ids"], r["labels"], r["vectors"], r["dim"], vectors.shape[1], leaf, fanout) for r in batch.to_pylist()]
            for a in anchors:
                a.search(trees)
        rows = [(a.vec_id, w, i, -s) for a in anchors for w, best in enumerate(a.best) for s, i in best]
        names, kinds = ("anchor_id", "w", "vec_id", "score"), (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], list(names))

    return run


def best_of(index: DataFrame, block, same: bool, k: int) -> DataFrame:
    """(anchor_id, w, vec_id, score, rank): the k best rows of each anchor and window over all tiles."""
    found = index.mapInArrow(searched(block, same, k), "anchor_id bigint, w int, vec_id bigint, score bigint")
    order = Window.partitionBy("anchor_id", "w").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def build_index(rows: DataFrame) -> DataFrame:
    """The packed tiles of all rows, unwritten."""
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
    dim = max((len(r["vector"]) for r in some), default=0)
    data = matrix([r["vector"] for r in some], dim)
    wide = [int(c) for c in np.argsort(-data.std(axis=0), kind="stable")[:2]] if dim else []
    at = lambda c: F.coalesce(F.get("vector", F.lit(c)), F.lit(0.0))
    cuts = sorted(set(np.quantile(data[:, wide[0]], np.arange(1, SLABS) / SLABS).tolist())) if wide else []
    slab = reduce(lambda a, b: a + b, (F.when(at(wide[0]) >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    order = ["label", "slab", "second", "vec_id"]
    placed = rows.withColumns({"slab": slab, "second": at(wide[-1]) if wide else F.lit(0.0)})
    tiles = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "label", "vector")
    size, leaf = TILE_ROWS, LEAF
    return tiles.mapInArrow(lambda batches: pack(batches, size, leaf), INDEX)


def anchor_blocks(anchors: DataFrame) -> Iterator[list]:
    """Anchors by id, ``BLOCK`` at a time."""
    held = []
    for row in anchors.orderBy("vec_id").toLocalIterator():
        held.append(row)
        if len(held) == BLOCK:
            yield held
            held = []
    if held:
        yield held


def mine(table: DataFrame, every: int = 100) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every`` (see the module's text)."""
    spark: SparkSession = table.sparkSession
    ship(spark)
    rows = keep(valid_rows(table))
    folder = scratch(spark, "hard-negatives")
    build_index(rows).write.parquet(folder)
    index = spark.read.schema(INDEX).parquet(folder)
    parts = []
    for block in anchor_blocks(rows.filter(F.col("vec_id") % every == 0)):
        ids, labels = [r["vec_id"] for r in block], [r["label"] for r in block]
        vectors = matrix([r["vector"] for r in block], max(len(r["vector"]) for r in block))
        anywhere = [[(-np.inf, np.inf)]] * len(ids)
        positives = keep(best_of(index, spark.sparkContext.broadcast((ids, labels, vectors, anywhere)), True, POSITIVES))
        scores: dict[int, set] = {i: set() for i in ids}
        for r in positives.select("anchor_id", "score").collect():  # at most POSITIVES rows per anchor of the block
            if r["score"] * LOW <= r["score"] * HIGH:
                scores[r["anchor_id"]].add(r["score"])
        # 80 p <= 100 n <= 100 p, in whole numbers
        windows = [[(-(-p * LOW // HIGH), p) for p in sorted(scores[i])] for i in ids]
        negatives = best_of(index, spark.sparkContext.broadcast((ids, labels, vectors, windows)), False, NEGATIVES)
        w = spark.createDataFrame([(i, k, p) for i, own in zip(ids, windows, strict=True) for k, (_, p) in enumerate(own)], "anchor_id bigint, w int, positive_score bigint")
        negatives = negatives.join(w, ["anchor_id", "w"]).select("anchor_id", "positive_score", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        of = positives.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        parts.append(keep(of.join(negatives, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")))
    remove(spark, folder)
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], RESULT)
