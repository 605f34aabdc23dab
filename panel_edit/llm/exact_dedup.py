"""Exact dedup by content-defined chunk recipes.

1. A rolling hash over the normalised bytes cuts every text into chunks, so
   that equal texts are cut alike and a shared passage gives shared chunks.
2. The chunk dictionary holds each distinct ``(digest, content)`` once. Rows
   that share a digest are compared by content; a digest with one content is a
   verified identifier, and for the rest ``(digest, number of the content)`` is.
3. A document becomes its recipe, the ordered list of identifiers. Documents
   are equal exactly if their recipes are, and from here on only recipes move.

The dictionary is shuffled once, after each task has dropped the chunks that it
has already sent; whole documents are never shuffled. Hot recipes are
pre-aggregated map-side, and the join back is one that AQE can split.

Defined cases: null text counts as empty; empty texts are equal to each other;
a repeated row (same doc_id, equal text) is kept or dropped with its twin;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panel_edit.llm.common import blocks, fresh, keep, ship, text_buffer

#: Chunk sizes in bytes: a cut falls where the top bits of the rolling hash are zero.
MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 512, 11, 16384
WINDOW_STEPS = 5  # the rolling hash sees 2**5 bytes
DIGEST_BYTES = 16

_DELETE = np.zeros(256, bool)
_DELETE[[9, 10, 11, 12, 13, 32]] = True
_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)

CHUNK_SCHEMA = "digest binary, content binary"
RECIPE_SCHEMA = "doc_id bigint, points bigint, text_sha256 string, recipe binary, raw_hash binary"


def blake(data: bytes) -> bytes:
    """The chunk digest (128 bits)."""
    return hashlib.blake2b(data, digest_size=DIGEST_BYTES).digest()


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Delete the white space of :data:`ASCII_SPACE` from consecutive texts."""
    stay = ~_DELETE[data]
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(stay, out=before[1:])
    return data[stay], before[offsets]


def cut_points(data: np.ndarray) -> np.ndarray:
    """Candidate cuts: positions after which the rolling hash calls for a cut."""
    h = _GEAR[data]
    for step in range(WINDOW_STEPS):  # sums over 2, 4, 8, ... bytes
        k = 1 << step
        older = h[:-k] << np.uint32(k) if k < 32 else np.zeros(max(len(h) - k, 0), np.uint32)
        h = h.copy()
        h[k:] += older
    return np.flatnonzero((h >> np.uint32(32 - MEAN_BITS)) == 0) + 1


def chunk_bounds(cuts: np.ndarray, size: int) -> list[int]:
    """Ends of the chunks of a text of ``size`` bytes, given its candidate cuts."""
    ends, last = [], 0
    for c in cuts.tolist():
        while c - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if c - last >= MIN_CHUNK and c < size:
            ends.append(c)
            last = c
    while size - last > MAX_CHUNK:
        last += MAX_CHUNK
        ends.append(last)
    if size > last:
        ends.append(size)
    return ends


def documents_in(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes, list[int]]]:
    """(row, code points of the original, normalised bytes, chunk ends) per text."""
    data, offsets = text_buffer(batch.column("text"))
    for i, j in blocks(offsets):
        raw, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        points = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
        points = np.diff(points[at])
        norm, at = normalise(raw, at)
        whole = norm.tobytes()
        for r in range(j - i):
            a, b = int(at[r]), int(at[r + 1])
            # Each text is cut on its own: the hash never sees its neighbours.
            cuts = cut_points(norm[a:b]) if b - a > MIN_CHUNK else np.zeros(0, np.int64)
            yield i + r, int(points[r]), whole[a:b], chunk_bounds(cuts, b - a)


def _pieces(text: bytes, ends: list[int]) -> Iterator[bytes]:
    start = 0
    for e in ends:
        yield text[start:e]
        start = e


#: A task forgets which chunks it has sent once it remembers this many.
REMEMBERED = 50_000


def _chunk_rows(digest: Callable[[bytes], bytes]):
    def run(batches):
        sent: set[bytes] = set()
        for batch in batches:
            keys, contents, size = [], [], 0
            for _, _, text, ends in documents_in(batch):
                for piece in _pieces(text, ends):
                    seen = hashlib.sha256(piece).digest()  # not the digest under test: contents that share one are both sent
                    if seen in sent:
                        continue
                    if len(sent) >= REMEMBERED:
                        sent.clear()
                    sent.add(seen)
                    keys.append(digest(piece))
                    contents.append(piece)
                    size += len(piece)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(contents, pa.binary())], ["digest", "content"])
                        keys, contents, size = [], [], 0
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(contents, pa.binary())], ["digest", "content"])

    return run


def _recipe_rows(digest: Callable[[bytes], bytes]):
    def run(batches):
        for batch in batches:
            points, sha, recipe = [], [], []
            for _, n, text, ends in documents_in(batch):
                points.append(n)
                sha.append(hashlib.sha256(text).hexdigest())
                recipe.append(b"".join(map(digest, _pieces(text, ends))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(points, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(recipe, pa.binary()), batch.column("raw_hash")],
                ["doc_id", "points", "text_sha256", "recipe", "raw_hash"])

    return run


def chunk_dictionary(docs: DataFrame, digest: Callable[[bytes], bytes] = blake) -> DataFrame:
    """Each distinct ``(digest, content)`` once; contents of one digest lie in one partition."""
    ship(docs.sparkSession)
    sent = docs.select("text").mapInArrow(_chunk_rows(digest), CHUNK_SCHEMA)
    return sent.repartition("digest").dropDuplicates(["digest", "content"])


def collisions(dictionary: DataFrame) -> DataFrame:
    """Digests that stand for more than one content (with a sound digest: none)."""
    return dictionary.groupBy("digest").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select("digest")


def _variants(docs: DataFrame, recipes: DataFrame, dictionary: DataFrame, clashing: DataFrame, digest) -> DataFrame:
    """Recipes followed by the numbers of their contents whose digest clashes."""

    def chunks_of(batches):
        for batch in batches:
            out = {"doc_id": [], "raw_hash": [], "seq": [], "digest": [], "content": []}
            ids, raw = batch.column("doc_id").to_pylist(), batch.column("raw_hash").to_pylist()
            for row, _, text, ends in documents_in(batch):
                for seq, piece in enumerate(_pieces(text, ends)):
                    for key, value in zip(out, (ids[row], raw[row], seq, digest(piece), piece)):
                        out[key].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["raw_hash"], pa.binary()), pa.array(out["seq"], pa.int32()),
                 pa.array(out["digest"], pa.binary()), pa.array(out["content"], pa.binary())], list(out))

    # Each clashing content gets a number of its own, fixed by being written.
    numbered = keep(dictionary.join(clashing, "digest", "left_semi").withColumn("variant", F.monotonically_increasing_id()))
    used = (docs.mapInArrow(chunks_of, "doc_id bigint, raw_hash binary, seq int, digest binary, content binary").distinct()
            .join(numbered, ["digest", "content"]))
    extra = used.groupBy("doc_id", "raw_hash").agg(F.array_sort(F.collect_list(F.struct("seq", "variant"))).cast("string").alias("extra"))
    return (recipes.join(extra, (recipes.doc_id.eqNullSafe(extra.doc_id)) & (recipes.raw_hash == extra.raw_hash), "left")
            .select(recipes.doc_id, "points", "text_sha256", F.concat("recipe", F.coalesce("extra", F.lit("")).cast("binary")).alias("recipe"), recipes.raw_hash))


def exact_groups(docs: DataFrame, digest: Callable[[bytes], bytes] = blake) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, raw_hash.

    Of equal texts (white space aside) the one with the most code points, then
    the smallest doc_id stays. ``raw_hash`` (sha-256 of the text as it is)
    tells apart rows that share a doc_id. A null doc_id sorts last.
    """
    ship(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("raw_hash"))
    recipes = keep(slim.mapInArrow(_recipe_rows(digest), RECIPE_SCHEMA))
    dictionary = chunk_dictionary(slim, digest)
    clashing = keep(collisions(dictionary))
    if not clashing.isEmpty():
        recipes = keep(_variants(slim, recipes, dictionary, clashing, digest))
    best = F.max(F.struct(F.col("points"), (-F.col("doc_id")).alias("low")))
    groups = recipes.groupBy("recipe").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    # Written first: the join then stands apart from the aggregate, so that AQE can split a hot recipe's partition.
    groups = keep(groups.select("recipe", (-F.col("best.low")).alias("keep_id"), F.col("best.points").alias("most"), "group_size"))
    return recipes.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("most"))).alias("kept"),
        "text_sha256", "raw_hash")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without exact copies; of repeated rows that stay, one is kept."""
    def key(doc_id, text_hash):
        return F.concat(F.coalesce(doc_id.cast("bigint").cast("string"), F.lit("")), F.lit(":"), text_hash)

    name = fresh(docs, "_row_key")
    stay = exact_groups(docs).where("kept").select(key(F.col("doc_id"), F.lower(F.hex("raw_hash"))).alias(name)).distinct()
    tagged = docs.withColumn(name, key(F.col("doc_id"), F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)))
    # The rows are dealt by the key once: the join and the removal of repeats share that.
    return tagged.join(stay, name, "left_semi").dropDuplicates([name]).select(*[F.col(f"`{c}`") for c in docs.columns])
