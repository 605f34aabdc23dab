"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad. The CRF scores a line's label from the
features of the line and of its neighbours, and each pair of neighbouring
labels. It is trained on a bounded sample of whole labelled documents, whose
label each of their lines takes over, by gradient ascent on the conditional
likelihood. Forward-backward gives the marginal of each line; a document's
score is the mean marginal of ``good``, weighted by line length, put on the
scale of the labels by a logistic curve fitted on the sample.

Labels, lang, source and doc_id are no inputs of a score.

Defined cases: null text counts as empty; an empty text is one empty line;
documents without a label are scored; repeated labels of one doc_id count
once, as good if any is; without labels of both classes every line is as good
as its share of letters; repeated rows get equal scores; extra columns are
ignored; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panel_edit.llm.common import blocks, keep, ship, text_buffer, words
from panel_edit.llm.toxicity import class_counts, held_out, training_ids

#: Bound of the training sample: documents and lines of each class. Documents are taken whole, in hash order,
#: as far as the lines go; one of more lines than that is in no sample.
PER_CLASS, CLASS_LINES = 4000, 400_000
#: Lines of a segment: longer texts are passed over by segments side by side.
SEGMENT = 256
THRESHOLD = 0.7

_CLASSES = {"upper": [*range(65, 91)], "lower": [*range(97, 123)], "digit": [*range(48, 58)], "space": [9, 11, 12, 13, 32],
            "stop": [ord(c) for c in ".,;:?'\"-()"], "bang": [33], "bar": [124], "mark": [ord(c) for c in "#$%&*+=<>[]{}\\^_`~@/"]}
_CLASS = np.zeros(256, np.int64)  # the rest: bytes of non-ASCII characters and control bytes
for _k, _members in enumerate(_CLASSES.values(), 1):
    _CLASS[_members] = _k
WIDTH = 16  # features of a line, before its neighbours' are added


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, weight, row) of every line of consecutive texts."""
    n = len(data)
    breaks = np.flatnonzero(data == 10)
    # A line ends at a newline or at its text's end.
    row = np.repeat(np.arange(len(offsets) - 1), np.bincount(np.searchsorted(offsets, breaks, "right") - 1, minlength=len(offsets) - 1) + 1)
    ends = np.empty(len(row), np.int64)
    last = np.cumsum(np.bincount(row, minlength=len(offsets) - 1)) - 1
    is_last = np.zeros(len(row), bool)
    is_last[last] = True
    ends[is_last], ends[~is_last] = offsets[1:], breaks
    starts = np.empty(len(row), np.int64)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    starts[1:] = ends[:-1] + 1
    starts[first] = offsets[:-1]
    lines = len(row)
    size = (ends - starts).astype(float)
    counts = np.empty((9, lines))
    kind = _CLASS[data]
    for k in range(9):
        sums = np.zeros(n + 1, np.int64)
        np.cumsum(kind == k, out=sums[1:])
        counts[k] = sums[ends] - sums[starts]
    other, upper, lower, digit, space, stop, bang, bar, mark = counts
    h, a, b, _ = words(data, offsets)
    line_of = np.searchsorted(starts, a, "right") - 1
    n_words = np.bincount(line_of, minlength=lines).astype(float)
    letters = np.bincount(line_of, b - a, lines)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (line_of[1:] == line_of[:-1])
    repeated = np.bincount(line_of, same, lines)
    key = (np.bincount(line_of, (h >> np.uint64(16)).astype(float), lines) * 31 + n_words) % 9007199254740881
    _, inverse, often = np.unique(np.column_stack([row.astype(float), key, size]), axis=0, return_inverse=True, return_counts=True)
    twin = (often[inverse.ravel()] > 1) & (n_words > 1)
    chars, tokens = np.maximum(size, 1), np.maximum(n_words, 1)
    x = np.column_stack([
        np.ones(lines), np.log1p(size) / 6, np.log1p(n_words) / 4, upper / np.maximum(upper + lower, 1), digit / chars, space / chars,
        stop / tokens, np.minimum(bang / tokens, 2), np.minimum(bar / tokens, 2), np.minimum(mark / tokens, 3), other / chars,
        repeated / tokens, letters / tokens / 10, twin.astype(float), (n_words == 0).astype(float), (n_words <= 2).astype(float)])
    return x, chars, row


def with_neighbours(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Features of a line, of the line before and of the line after (zero at a text's ends)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    if len(x) > 1:
        same = (row[1:] == row[:-1])[:, None]
        before[1:] = x[:-1] * same
        after[:-1] = x[1:] * same
    return np.concatenate([x, before, after], axis=1)


class Chains:
    """Lines of many texts in segments, laid out by place in the segment, for vectorised passes."""

    def __init__(self, row: np.ndarray, n: int):
        sizes = np.bincount(row, minlength=n)
        many = -(-sizes // SEGMENT)
        self.firsts = np.concatenate([[0], np.cumsum(many)[:-1]]).astype(np.int64)  # first segment of each text
        text = np.repeat(np.arange(n), many)
        place = np.arange(len(text)) - self.firsts[text]
        self.first = (np.cumsum(sizes) - sizes)[text] + place * SEGMENT  # first line of each segment
        self.sizes = np.minimum(sizes[text] - place * SEGMENT, SEGMENT)
        self.later = np.flatnonzero(place > 0)  # segments that have one before them
        self.inner = np.flatnonzero(row[1:] == row[:-1]) + 1  # lines that have one before them
        self.order, self.steps = self._prefixes(self.sizes)
        self.texts, self.rounds = self._prefixes(many)

    @staticmethod
    def _prefixes(sizes: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The longest first, and how many have so many places: a step is a prefix."""
        order = np.argsort(-sizes, kind="stable")
        return order, [int(k) for k in np.searchsorted(-sizes[order], -np.arange(1, (sizes.max() if len(sizes) else 0) + 1), "right")]

    def at(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Segments that have so many lines, and their lines at place ``t``."""
        segments = self.order[:self.steps[t]]
        return segments, self.first[segments] + t

    def following(self, k: int) -> np.ndarray:
        """The segments at place ``k`` of the texts that have so many."""
        return self.firsts[self.texts[:self.rounds[k]]] + k


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Crf:
    """Two labels (0 bad, 1 good): weights of the features for ``good`` and of label pairs."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray, scale=(1.0, 0.0)):
        self.weights, self.pairs, self.scale = weights, pairs, scale

    def passes(self, x: np.ndarray, chains: Chains):
        """(marginal of each label per line, expected label pairs per text, log partition per text)."""
        unary = np.zeros((len(x), 2))
        unary[:, 1] = x @ self.weights
        forward, backward = unary.copy(), np.zeros_like(unary)
        first, later = chains.first, chains.later
        if len(later):
            # What leads from a label at the end of the segment before to one at this segment's end.
            through = np.repeat(unary[first][:, None, :], 2, axis=1)
            through[later] += self.pairs
            for t in range(1, len(chains.steps)):
                segments, now = chains.at(t)
                through[segments] = _logsum(through[segments][:, :, :, None] + self.pairs, 2) + unary[now][:, None, :]
            ends, after = through[:, 0].copy(), np.zeros((len(first), 2))
            for k in range(1, len(chains.rounds)):
                now = chains.following(k)
                ends[now] = _logsum(ends[now - 1][:, :, None] + through[now], 1)
            for k in range(len(chains.rounds) - 1, 0, -1):
                now = chains.following(k)
                after[now - 1] = _logsum(through[now] + after[now][:, None, :], 2)
            forward[first[later]] += _logsum(ends[later - 1][:, :, None] + self.pairs, 1)
            backward[first + chains.sizes - 1] = after
        for t in range(1, len(chains.steps)):
            now = chains.at(t)[1]
            forward[now] += _logsum(forward[now - 1][:, :, None] + self.pairs, 1)
        for t in range(len(chains.steps) - 1, 0, -1):
            now = chains.at(t)[1]
            backward[now - 1] = _logsum(self.pairs + (unary[now] + backward[now])[:, None, :], 2)
        joint = forward + backward
        z = _logsum(joint, 1)
        return np.exp(joint - z[:, None]), forward, backward, unary, z

    def pair_counts(self, forward, backward, unary, z, chains: Chains, weight: np.ndarray) -> np.ndarray:
        now = chains.inner
        p = forward[now - 1][:, :, None] + self.pairs + (unary[now] + backward[now])[:, None, :] - z[now][:, None, None]
        return (np.exp(p) * weight[now][:, None, None]).sum(axis=0)

    def quality(self, x: np.ndarray, chars: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Length-weighted mean marginal of ``good`` per text."""
        good = self.passes(x, Chains(row, n))[0][:, 1]
        return np.bincount(row, good * chars, n) / np.maximum(np.bincount(row, chars, n), 1e-9)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        x, chars, row = line_features(data, offsets)
        a, b = self.scale
        q = np.clip(self.quality(with_neighbours(x, row), chars, row, n), 1e-4, 1 - 1e-4)
        # Rounded: the last bits of a sum depend on what else is in the batch.
        return np.round(1 / (1 + np.exp(-(a * np.log(q / (1 - q)) + b))), 9)


def train(x: np.ndarray, row: np.ndarray, y: np.ndarray, weight: np.ndarray, chars: np.ndarray, rounds: int = 150, l2: float = 1e-3) -> Crf:
    """Maximise the conditional likelihood of the lines' labels (each its document's), by Adam."""
    n = len(y)
    chains = Chains(row, n)
    target = y[row].astype(float)
    w = weight[row] / np.bincount(row, minlength=n)[row]  # every document counts alike, however many lines it has
    w = w / w.sum()
    same = np.flatnonzero(np.concatenate([[False], row[1:] == row[:-1]]))
    seen = np.zeros((2, 2))
    for k in (0, 1):
        seen[k, k] = w[same][target[same] == k].sum()
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    crf = Crf(theta[:-4], theta[-4:].reshape(2, 2))
    for t in range(1, rounds + 1):
        crf = Crf(theta[:-4], theta[-4:].reshape(2, 2))
        marginal, forward, backward, unary, z = crf.passes(x, chains)
        g = np.concatenate([x.T @ (w * (target - marginal[:, 1])), (seen - crf.pair_counts(forward, backward, unary, z, chains, w)).ravel()]) - l2 * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    crf = Crf(theta[:-4], theta[-4:].reshape(2, 2))
    # The scale: a logistic curve from the log-odds of the mean marginal to the label.
    q = np.clip(crf.quality(x, chars, row, n), 1e-4, 1 - 1e-4)
    s, a, b = np.log(q / (1 - q)), 1.0, 0.0
    for _ in range(50):  # Newton steps, slightly ridged
        p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
        e, c = weight * (y - p), weight * p * (1 - p)
        gradient = np.array([(e * s).sum() - 0.01 * (a - 1), e.sum()])
        hessian = np.array([[(c * s * s).sum() + 0.01, (c * s).sum()], [(c * s).sum(), c.sum() + 0.01]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a + np.clip(step[0], -1, 1), b + np.clip(step[1], -1, 1)
    crf.scale = (float(max(a, 0.05)), float(b))
    return crf


def fixed_model() -> Crf:
    """The model where there is nothing to learn from: marks, shouting and repetition are bad."""
    weights = np.zeros(3 * WIDTH)
    weights[[0, 3, 7, 8, 9, 11, 13]] = [2.0, -3.0, -3.0, -3.0, -3.0, -3.0, -1.0]
    return Crf(weights, np.array([[0.5, -0.5], [-0.5, 0.5]]))


def _sample_rows(batches):
    """Features of the lines of the sampled texts."""
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        packed = []
        for i, j in blocks(offsets):
            x, chars, row = line_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            both = np.column_stack([x, chars]).astype(np.float32)
            cut = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=j - i))])
            packed += [both[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(packed, pa.binary())], ["doc_id", "y", "lines"])


def whole_documents(docs: DataFrame, ids: DataFrame, lines: int) -> DataFrame:
    """Of ``ids`` (doc_id, y) those whose documents, taken whole in hash order, have up to ``lines`` lines in each class."""
    n = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[^\n]+", "")) + 1
    sizes = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("y").alias("y"), F.max(n).alias("n"))
    taken, left = [], {0: lines, 1: lines}
    for r in sizes.orderBy(F.xxhash64("doc_id"), "doc_id").collect():  # as many as the ids, three numbers each
        if r.n <= lines:
            left[r.y] -= r.n
            if left[r.y] >= 0:
                taken.append((r.doc_id, r.y))
            else:
                left[r.y] = -1  # the class is full
    return docs.sparkSession.createDataFrame(taken, "doc_id bigint, y int")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Crf:
    """The CRF, from a bounded sample of labelled documents."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = whole_documents(texts, training_ids(labels, "quality", per_class), CLASS_LINES)
    sample = keep(texts.join(F.broadcast(ids), "doc_id").select("doc_id", "y", "text").mapInArrow(_sample_rows, "doc_id bigint, y int, lines binary")
                  .groupBy("doc_id").agg(F.min(F.struct("y", "lines")).alias("r")))
    rows = sorted((r.r for r in sample.collect()), key=lambda r: (r.y, r.lines))  # at most 2 * per_class; an order that no partitioning changes
    y = np.array([r.y for r in rows])
    if not len(y) or y.min() == y.max():
        return fixed_model()
    parts = [np.frombuffer(r.lines, np.float32).reshape(-1, WIDTH + 1).astype(float) for r in rows]
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    both = np.concatenate(parts)
    shares = {r.y: r.n for r in class_counts(labels, "quality").collect()}
    weight = np.where(y > 0, shares[1] / (y > 0).sum(), shares[0] / (y == 0).sum())
    return train(with_neighbours(both[:, :-1], row), row, y, weight / weight.mean(), both[:, -1])


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels)

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            found = [model.scores(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in blocks(offsets)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())], ["doc_id", "score"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
