"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, edit verification.

Texts are lower-cased and read as words. The CGK walk over a window writes one
word per step and moves on, or stays, by a random bit of (step, word): windows
at a small edit distance give embeddings at a small Hamming distance. A hash
function samples SAMPLES steps of the embedding; WALKS walks with SETS samples
each are tried, enough for TARGET_RECALL. Verbatim passages are found with
certainty.

* Item side: windows of a length below the item's (``LENGTHS``), at up to
  ``PLACES`` places spread from its first to its last words, ``STRIDE`` offsets
  at each. A walk through a long window comes through few edits, so a long item
  has several short windows.
* Document side: windows of the same lengths at every STRIDE-th word, so that
  one of any STRIDE offsets of a passage is met.
* The samples of a window are compared one by one, and a window is given up
  once its samples so far are no item's: the hash join, evaluated lazily.
* Of what agrees in all samples, the Hamming distance of the whole embeddings
  is taken; pairs that differ in more than AGREE allows are chance.
* The rest is verified: the edit distance between the item and its best match
  near the window, over characters of the normalised texts.

Benchmark items come to the driver in blocks of at most ITEM_BLOCK, and each
block's index goes to all tasks; the documents are passed through in one
stage, without a shuffle.

Defined cases: null texts count as empty; an item without words is never
found; an item of fewer than SHORT words is searched at every word; equal items
are found together; extra columns are kept aside or passed through; empty
tables give empty or unflagged results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panel_edit.llm.common import blocks, fresh, keep, mix, ship, text_buffer, words

#: Share of an item's characters that may be edited.
MAX_EDIT = 0.2
#: Words between the starts of document windows; items of fewer than SHORT words use 1.
STRIDE, SHORT = 4, 8
#: Window lengths in words (an item uses the largest that fits all its offsets). One window of 14 words meets 97 in 100
#: copies with 15 % of their words edited, one of 20 words 95 and one of 55 words about 80, so none is longer than 14.
LENGTHS = [1, 2, 3, 4, 5, 7, 10, 14]
#: Places of a long item that have windows.
PLACES = 4
#: Share of the copies with up to 15 % of their words edited (and within MAX_EDIT) that are to be found;
#: the numbers below reach it (a test measures it). A walk fails as a whole, so more walks tell more than more samples.
TARGET_RECALL = 0.95
#: Walks, hash functions for each walk and length, sampled steps for each function.
WALKS, SETS, SAMPLES = 4, 4, 4
#: Share of the steps outside a function's samples in which the embeddings of a candidate agree.
#: Unrelated windows agree in about 6 in 100.
AGREE = 0.3
#: Items whose index is sent to the tasks at a time.
ITEM_BLOCK = 20_000

_PAD = np.uint64(0x6A09E667F3BCC909)
_CHAIN = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 18


def _words_of(text: str) -> tuple[np.ndarray, str]:
    """Hashes of a text's words, and the words joined by one space."""
    data, offsets = text_buffer(pa.array([text]), lower=True)
    h, a, b, _ = words(data, offsets)
    raw = data.tobytes()
    return h, " ".join(raw[x:y].decode("utf-8", "replace") for x, y in zip(a.tolist(), b.tolist()))


class Walk:
    """One CGK walk: the multiplier of each step, whose top bit of the product moves on."""

    def __init__(self, rng: np.random.Generator, steps: int):
        self.factors = rng.integers(0, 1 << 63, steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Probe:
    """One hash function: the sampled steps of one walk for windows of one length."""

    def __init__(self, rng: np.random.Generator, walk: int, length: int):
        self.walk, self.length = walk, length
        self.steps = np.sort(rng.choice(2 * length, min(SAMPLES, 2 * length), replace=False)).tolist()
        self.seed = np.uint64(rng.integers(0, 1 << 63))
        self.filters: list[np.ndarray] = []
        self.keys = self.windows = None


def advance(symbols: np.ndarray, factor: np.uint64) -> np.ndarray:
    return ((symbols * factor) >> np.uint64(63)).astype(np.int64)


def extend(h: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The key of the samples so far, with one more."""
    return mix((h * _CHAIN) ^ symbols)


class ItemIndex:
    """The LSH tables of a block of items."""

    def __init__(self, items: list[tuple[int, str]], stride: int, seed: int = 1):
        self.stride = stride
        self.items = []  # (item_id, normalised text, words)
        places: dict[int, set[tuple[int, int]]] = {}
        hashes = []
        for item_id, text in items:
            h, line = _words_of(text)
            if not len(h):
                continue
            k = len(self.items)
            self.items.append((item_id, line, len(h)))
            hashes.append(h)
            length = max(x for x in LENGTHS if x <= max(1, len(h) - stride + 1))
            last = len(h) - length
            spread = max(0, last - stride + 1)  # where the last run of offsets begins
            runs = min(PLACES, 1 + -(-spread // stride))
            for first in {spread * j // max(1, runs - 1) for j in range(runs)}:
                places.setdefault(length, set()).update((k, at) for at in range(first, min(first + stride, last + 1)))
        by_length = {length: sorted(found) for length, found in places.items()}
        rng = np.random.default_rng(seed)
        longest = max(by_length, default=1)
        self.longest = longest
        self.walks = [Walk(rng, 2 * longest) for _ in range(WALKS)]
        self.probes = [Probe(rng, w, length) for length in sorted(by_length) for w in range(WALKS) for _ in range(SETS)]
        flat = np.concatenate([*hashes, np.zeros(2 * longest + 1, np.uint64)]) if hashes else np.zeros(0, np.uint64)
        first = np.cumsum([0, *map(len, hashes)])
        by_length = {k: np.array(v) for k, v in by_length.items()}
        self.flat, self.first, self.by_length = flat, first, by_length
        for w, walk in enumerate(self.walks):
            for probe in (p for p in self.probes if p.walk == w):
                windows = by_length[probe.length]
                start = first[windows[:, 0]] + windows[:, 1]
                at, h = start.copy(), np.full(len(start), probe.seed)
                for step in range(probe.steps[-1] + 1):
                    s = flat[at]
                    if step in probe.steps:
                        h = extend(h, np.where(at - start < probe.length, s, _PAD))
                        bits = np.zeros(1 << _FILTER_BITS, bool)
                        bits[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
                        probe.filters.append(np.packbits(bits))
                    at += advance(s, walk.factors[step])
                probe.windows = np.argsort(h)
                probe.keys = h[probe.windows]

    def embed(self, walk: int, length: int, flat: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The embedding of the windows of ``flat`` that begin at ``start``: one row per step."""
        at, out = start.copy(), np.empty((2 * length, len(start)), np.uint64)
        for step in range(2 * length):
            s = flat[at]
            out[step] = np.where(at - start < length, s, _PAD)
            at += advance(s, self.walks[walk].factors[step])
        return out

    def near(self, walk: int, length: int, flat: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Of the (start, window) pairs those whose embeddings agree by more than chance."""
        windows = self.by_length[length][pairs[:, 1]]
        ours = self.embed(walk, length, flat, pairs[:, 0])
        theirs = self.embed(walk, length, self.flat, self.first[windows[:, 0]] + windows[:, 1])
        samples = min(SAMPLES, 2 * length)
        agree = (ours == theirs).sum(axis=0) - samples
        ok = agree >= AGREE * (2 * length - samples)
        return np.column_stack([pairs[ok, 0], windows[ok]])

    def candidates(self, hashes: np.ndarray, row: np.ndarray):
        """(word index, item, offset in the item) of the windows that agree in all samples of a function."""
        n = len(hashes)
        if not n or not self.items:
            return np.zeros((0, 3), np.int64)
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        sizes = np.diff(np.append(first, n))
        place = np.arange(n) - np.repeat(first, sizes)  # place of a word in its text
        left = np.repeat(sizes, sizes) - place
        starts = np.flatnonzero(place % self.stride == 0)
        left = left[starts]
        lengths = sorted({p.length for p in self.probes})
        fit = {length: np.flatnonzero(left >= length) for length in lengths}
        flat = np.concatenate([hashes, np.zeros(2 * self.longest + 1, np.uint64)])
        found = [np.zeros((0, 3), np.int64)]
        for w, walk in enumerate(self.walks):
            met: dict[int, list[np.ndarray]] = {}
            due: dict[int, list[tuple[Probe, int]]] = {}
            for p in self.probes:
                if p.walk == w and len(fit[p.length]):
                    for depth, step in enumerate(p.steps):
                        due.setdefault(step, []).append((p, depth))
            alive: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            at = starts.copy()
            for step in range(max(due, default=-1) + 1):
                s = flat[at]
                for p, depth in due.get(step, ()):
                    here, h = alive.pop(id(p), (fit[p.length], None))
                    if h is None:
                        h = np.full(len(here), p.seed)
                    if not len(here):
                        alive[id(p)] = here, h
                        continue
                    mine = s[here]
                    if step >= p.length:
                        mine = np.where(at[here] - starts[here] < p.length, mine, _PAD)
                    h = extend(h, mine)
                    slot = (h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)
                    ok = np.flatnonzero((p.filters[depth][slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1)
                    here, h = here[ok], h[ok]
                    if depth + 1 < len(p.steps):
                        alive[id(p)] = here, h
                        continue
                    lo, hi = np.searchsorted(p.keys, h), np.searchsorted(p.keys, h, "right")
                    many = hi - lo
                    within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    met.setdefault(p.length, []).append(
                        np.column_stack([starts[np.repeat(here, many)], p.windows[np.repeat(lo, many) + within]]))
                at += advance(s, walk.factors[step])
            for length, pairs in met.items():
                pairs = np.unique(np.concatenate(pairs), axis=0)
                found += [self.near(w, length, flat, pairs[k:k + 4096]) for k in range(0, len(pairs), 4096)]
        return np.unique(np.concatenate(found), axis=0)


def best_match(pattern: str, text: str) -> int:
    """Smallest edit distance between ``pattern`` and any substring of ``text`` (bit-parallel)."""
    m = len(pattern)
    if not m:
        return 0
    if pattern in text:
        return 0
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = mask, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & mask
        mh = (mh << 1) & mask
        pv = (mh | ~(xv | ph)) & mask
        mv = ph & xv
        if score < best:
            best = score
    return best


def may_match(pattern: str, text: str, edits: int) -> bool:
    """False only where no substring of ``text`` is within ``edits`` of ``pattern``: an edit spoils at most three trigrams."""
    need = len(pattern) - 2 - 3 * edits
    if need <= 0:
        return True
    grams = {text[i:i + 3] for i in range(len(text) - 2)}
    return sum(pattern[i:i + 3] in grams for i in range(len(pattern) - 2)) >= need


def search(index: ItemIndex, data: np.ndarray, offsets: np.ndarray, max_edit: float) -> dict[int, dict[int, int]]:
    """``{row: {item_id: distance}}`` of the items found in consecutive texts."""
    h, a, b, row = words(data, offsets)
    raw = None
    out: dict[int, dict[int, int]] = {}
    tried: set[tuple[int, int, int]] = set()
    for start, k, at in index.candidates(h, row).tolist():
        item_id, line, n = index.items[k]
        r = int(row[start])
        slack = max(2, int(2 * max_edit * n))
        begin = start - at  # where the item would start
        key = (r, k, begin // max(1, slack // 2))
        if key in tried or out.get(r, {}).get(item_id) == 0:
            continue
        tried.add(key)
        if raw is None:
            raw = data.tobytes()
            first = np.searchsorted(row, np.arange(len(offsets) - 1))
            last = np.searchsorted(row, np.arange(len(offsets) - 1), "right")
        lo, hi = max(begin - slack, int(first[r])), min(begin + n + slack, int(last[r]))
        text = " ".join([raw[x:y].decode("utf-8", "replace") for x, y in zip(a[lo:hi].tolist(), b[lo:hi].tolist())])
        edits = int(max_edit * len(line))
        if not may_match(line, text, edits):
            continue
        distance = best_match(line, text)
        if distance <= edits:
            mine = out.setdefault(r, {})
            mine[item_id] = min(distance, mine.get(item_id, distance))
    return out


def _search_rows(index: ItemIndex, max_edit: float, hits: str):
    """Fill the last column with the items found, on top of what it has."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"), lower=True)
            lists = [list(x or []) for x in batch.column(hits).to_pylist()]
            for i, j in blocks(offsets):
                for r, items in search(index, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], max_edit).items():
                    lists[i + r] += [{"item_id": k, "distance": d} for k, d in sorted(items.items())]
            at = batch.schema.get_field_index(hits)
            yield batch.set_column(at, hits, pa.array(lists, pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32())]))))

    return run


HITS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType())]))


def with_hits(docs: DataFrame, benchmark: DataFrame, column: str, max_edit: float = MAX_EDIT) -> DataFrame:
    """``docs`` and, as ``column``, the benchmark items that each text holds, with their edit distances."""
    ship(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = max(1, -(-items.count() // ITEM_BLOCK))
    out = docs.withColumn("text", F.col("text").cast("string")).withColumn(column, F.array().cast(HITS))
    for block in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect() if n > 1 else items.collect()
        sizes = {id(r): len(_words_of(r.text)[0]) for r in rows}
        for stride, part in ((STRIDE, [r for r in rows if sizes[id(r)] >= SHORT]), (1, [r for r in rows if 0 < sizes[id(r)] < SHORT])):
            if part:
                part = sorted({(r.item_id if r.item_id is not None else -1, r.text) for r in part})
                out = out.mapInArrow(_search_rows(ItemIndex(part, stride), max_edit, column), out.schema)
        if block + 1 < n:  # blocks take turns: a worker holds the index of one
            out = keep(out)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT) -> DataFrame:
    """One row per document: doc_id, contaminated, item_ids (sorted), distances (in their order)."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = with_hits(slim, benchmark, "hits", max_edit)
    hits = F.array_sort("hits")
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"),
                        hits["item_id"].alias("item_ids"), hits["distance"].alias("distances"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    column = fresh(docs, "_hits")
    return with_hits(docs, benchmark, column, max_edit).where(F.size(column) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
