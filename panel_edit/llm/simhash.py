"""SimHash near-dedup by a self-join of the binary trie of fingerprints.

1. Every document gets a 64-bit fingerprint: a bit is set where it is set in
   over half the hashes of its word shingles.
2. The distinct fingerprints form a binary trie. Its upper part is cut where
   a node holds at most ``capacity`` of them; only the counts of those nodes,
   a bounded number, come to the driver. Node pairs are traversed together
   from the root: a pair of children takes over the differing bits of its
   parents, and is pruned once they exceed the error budget.
3. Each remaining pair of cut nodes is one row with two sorted arrays; the
   traversal goes on inside them, in numpy, down to the leaves.
4. Linked pairs in one cell are reduced to a spanning forest before they leave
   the task, so a dense cluster gives as many rows as members, not as pairs.
   Components of the forest edges come from alternating large-star and
   small-star steps.

Copies share one fingerprint and enter the join once.

Defined cases: null text counts as empty; documents without words have
fingerprint 0 and are linked as any other; a repeated row gets a row of its
own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panel_edit.llm.common import fresh, keep, ship

BITS = 64
#: Fingerprints below one cut node of the trie: at least CAPACITY, or enough
#: that no more than NODES nodes are needed on one level.
CAPACITY, NODES = 8192, 4096
#: Bits by which a node that holds too many is refined at a time; bits of the first cut.
FIRST_BITS, STEP_BITS = 8, 4
#: Node pairs that a traversal holds at a time, and nodes small enough to be compared directly.
PAIRS_AT_ONCE, SMALL = 1 << 18, 4
#: Shingle hashes counted at a time.
COUNT_BLOCK = 1 << 15


def fingerprint(text: str, size: int, seed: int = 42) -> int:
    """SimHash of one text: lower-cased A-Z, words between ASCII white space, ``size``-word shingles."""
    found = text.encode().lower().split()
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(found) <= size:
        return digest(b" ".join(found), seed)
    n = len(found) - size + 1
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[size - 1:].tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, COUNT_BLOCK):
        h = np.array([digest(line[a:b], seed) for a, b in zip(starts[at:at + COUNT_BLOCK], ends[at:at + COUNT_BLOCK])], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprint_rows(size: int):
    def run(batches):
        for batch in batches:
            values = [fingerprint(t or "", size) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer."""
    ship(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_fingerprint_rows(shingle), "doc_id bigint, fp bigint")


# The upper part of the trie.


def cut_nodes(distinct: DataFrame, capacity: int | None = None) -> list[tuple[int, int, int]]:
    """(depth, prefix, count) of the trie nodes that together hold all fingerprints.

    Each holds at most the capacity (or is a leaf). Brought to the driver per
    round are at most ``2**FIRST_BITS`` counts, then ``2**STEP_BITS`` per node
    that holds too many; there are at most NODES of those.
    """
    def counts(frame: DataFrame, depth: int) -> list:
        prefix = F.shiftrightunsigned("fp", BITS - depth).alias("prefix")
        return [(r.prefix, r.n) for r in frame.groupBy(prefix).agg(F.count(F.lit(1)).alias("n")).collect()]

    found, depth = counts(distinct, FIRST_BITS), FIRST_BITS
    total = sum(n for _, n in found)
    capacity = capacity or max(CAPACITY, -(-total // NODES))
    nodes: list[tuple[int, int, int]] = []
    while found:
        nodes += [(depth, p, n) for p, n in found if n <= capacity or depth == BITS]
        heavy = [p for p, n in found if n > capacity and depth < BITS]
        if not heavy:
            break
        spark = distinct.sparkSession
        wanted = spark.createDataFrame([(p,) for p in heavy], "prefix bigint")
        inside = distinct.withColumn("prefix", F.shiftrightunsigned("fp", BITS - depth)).join(F.broadcast(wanted), "prefix", "left_semi")
        depth = min(BITS, depth + STEP_BITS)
        found = counts(inside, depth)
    return nodes


def node_pairs(nodes: list[tuple[int, int, int]], budget: int) -> list[tuple[int, int]]:
    """Indices (i <= j) of the cut nodes whose subtrees may hold a link.

    Traverses pairs of nodes from the root of the cut trie; a pair carries the
    differing bits of its common depth and is dropped beyond the budget.
    """
    below: dict[tuple[int, int], int] = {}  # inner nodes of the cut trie
    leaf = {}
    for i, (depth, prefix, _) in enumerate(nodes):
        leaf[(depth, prefix)] = i
        for d in range(depth):
            below[(d, prefix >> (depth - d))] = 1
    if not nodes:
        return []

    def children(node):
        if node in leaf:
            return [node]
        d, p = node
        return [c for c in ((d + 1, 2 * p), (d + 1, 2 * p + 1)) if c in leaf or c in below]

    def differing(a, b):
        d = min(a[0], b[0])
        return ((a[1] >> (a[0] - d)) ^ (b[1] >> (b[0] - d))).bit_count()

    stack, out = [((0, 0), (0, 0))], []
    while stack:
        a, b = stack.pop()
        if a in leaf and b in leaf:
            out.append((min(leaf[a], leaf[b]), max(leaf[a], leaf[b])))
            continue
        for x in children(a):
            for y in children(b):
                if (a != b or x <= y) and differing(x, y) <= budget:
                    stack.append((x, y))
    return sorted(set(out))


# The traversal inside a pair of cut nodes.


def _split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where the one-child of each node ``values[lo:hi]`` begins (values sorted, equal above ``bit``)."""
    if not len(lo):
        return lo
    boundary = ((values[lo] >> np.uint64(bit)) | np.uint64(1)) << np.uint64(bit)
    return np.clip(np.searchsorted(values, boundary), lo, hi)


def linked(a: np.ndarray, b: np.ndarray, same: bool, budget: int, depth: int = 0):
    """Yield index pairs of values (sorted uint64) at most ``budget`` bits apart.

    ``same``: a and b are one array, and each pair comes once.
    """
    if not len(a) or not len(b):
        return
    one = np.array([0])
    stack = [(depth, one, np.array([len(a)]), one, np.array([len(b)]))]
    while stack:
        depth, alo, ahi, blo, bhi = stack.pop()
        if len(alo) > PAIRS_AT_ONCE:  # depth first in parts, so that memory is bounded
            k = len(alo) // 2
            stack += [(depth, alo[:k], ahi[:k], blo[:k], bhi[:k]), (depth, alo[k:], ahi[k:], blo[k:], bhi[k:])]
            continue
        few = ((ahi - alo) <= SMALL) & ((bhi - blo) <= SMALL)
        if depth == BITS or few.all():
            few = np.ones(len(alo), bool)
        for da in range(SMALL if depth < BITS else 1):
            for db in range(SMALL if depth < BITS else 1):
                i, j = alo[few] + da, blo[few] + db
                ok = (i < ahi[few]) & (j < bhi[few])
                i, j = i[ok], j[ok]
                ok = np.bitwise_count(a[i] ^ b[j]) <= budget
                if same:
                    ok &= i < j
                if ok.any():
                    yield i[ok], j[ok]
        alo, ahi, blo, bhi = alo[~few], ahi[~few], blo[~few], bhi[~few]
        if not len(alo):
            continue
        bit = BITS - 1 - depth
        amid, bmid = _split(a, alo, ahi, bit), _split(b, blo, bhi, bit)
        parts = [(alo, amid, blo, bmid), (alo, amid, bmid, bhi), (amid, ahi, blo, bmid), (amid, ahi, bmid, bhi)]
        parts = [np.concatenate(x) for x in zip(*parts)]
        live = (parts[0] < parts[1]) & (parts[2] < parts[3])
        if same:
            live &= parts[0] <= parts[2]
        parts = [x[live] for x in parts]
        # Differing bits so far: of any two members, whose bits down to here are the nodes'.
        over = np.bitwise_count((a[parts[0]] ^ b[parts[2]]) >> np.uint64(bit)) if len(parts[0]) else np.zeros(0, int)
        parts = [x[over <= budget] for x in parts]
        if len(parts[0]):
            stack.append((depth + 1, *parts))


def forest(n: int, pairs) -> np.ndarray:
    """Smallest index of the component of each of ``n`` vertices (pairs come in blocks)."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            ri, rj = root[i], root[j]
            open_ = ri != rj
            if not open_.any():
                break
            i, j, ri, rj = i[open_], j[open_], ri[open_], rj[open_]
            np.minimum.at(root, np.maximum(ri, rj), np.minimum(ri, rj))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def _cell_rows(budget: int):
    def run(batches):
        for batch in batches:
            for same, a, b in zip(batch.column("same").to_pylist(), batch.column("a"), batch.column("b")):
                a = np.sort(np.asarray(a.values).view(np.uint64))
                b = a if same else np.sort(np.asarray(b.values).view(np.uint64))
                if same:
                    values, pairs = a, linked(a, a, True, budget)
                else:
                    values = np.concatenate([a, b])
                    pairs = ((i, j + len(a)) for i, j in linked(a, b, False, budget))
                root = forest(len(values), pairs)
                moved = np.flatnonzero(root != np.arange(len(values)))
                x, y = values.view(np.int64)[moved], values.view(np.int64)[root[moved]]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], ["u", "v"])

    return run


def links(distinct: DataFrame, budget: int, capacity: int | None = None) -> DataFrame:
    """Forest edges (u > v) that connect all fingerprints at most ``budget`` bits apart."""
    spark: SparkSession = distinct.sparkSession
    nodes = cut_nodes(distinct, capacity)
    pairs = node_pairs(nodes, budget)
    # Cut nodes in order of their first fingerprint: a fingerprint's node is found by binary search.
    order = sorted(range(len(nodes)), key=lambda i: nodes[i][1] << (BITS - nodes[i][0]))
    first = np.array([nodes[i][1] << (BITS - nodes[i][0]) for i in order], np.uint64)
    names = np.array(order, np.int64)

    def place(batches):
        for batch in batches:
            fp = np.asarray(batch.column("fp"))
            at = np.searchsorted(first, fp.view(np.uint64), "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(names[at]), batch.column("fp")], ["node", "fp"])

    placed = distinct.select("fp").mapInArrow(place, "node bigint, fp bigint")
    members = keep(placed.groupBy("node").agg(F.collect_list("fp").alias("fps")))  # at most the capacity in a row
    cells = spark.createDataFrame(pd.DataFrame(pairs or [(-1, -1)], columns=["i", "j"]).astype("int64"))
    both = (cells.join(members.select(F.col("node").alias("i"), F.col("fps").alias("a")), "i")
            .repartition("j", "i")
            .join(members.select(F.col("node").alias("j"), F.col("fps").alias("b")), "j")
            .select((F.col("i") == F.col("j")).alias("same"), "a", "b"))
    return both.mapInArrow(_cell_rows(budget), "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """(member, root) of each vertex of the edges that is not its component's root.

    Alternates large-star (larger neighbours move to the smallest of a
    vertex's neighbourhood) and small-star (smaller neighbours do) until no
    edge changes.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        seen = both.join(low, "u")
        if large:
            out = seen.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = seen.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        return out.where(F.col("u") != F.col("v")).distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = keep(edges.distinct())
    before = state(edges)
    while before[0]:
        edges = keep(star(star(edges, True), False))
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("member"), F.col("v").alias("root"))


def near_groups(docs: DataFrame, shingle: int = 3, budget: int = 2, capacity: int | None = None) -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest doc_id reachable)."""
    rows = keep(fingerprints(docs, shingle))
    distinct = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = components(links(distinct, budget, capacity))
    named = distinct.join(roots, distinct.fp == roots.member, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = named.join(lowest, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """``docs`` with the smallest doc_id of each component only."""
    groups = near_groups(docs, shingle, budget)
    name = fresh(docs, "_stays")
    stay = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(stay, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")
