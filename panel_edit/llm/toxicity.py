"""Toxicity by weak supervision.

1. A bounded sample of labelled documents (``PER_CLASS`` of each class, the
   smallest hashes of doc_id; held-out rows never; equal texts of a class once)
   picks the voters' words and the prior, and nothing else: words and word
   beginnings ``MIN_LIFT`` times as frequent in toxic documents, with a
   log-likelihood ratio over ``MIN_RATIO``. All that pass are taken.
2. Voters: groups of those words, a fixed lexicon per language, patterns (shouting, masked words, insults addressed to a reader).
   Each fires or not on each sampled document. The given label is no voter.
3. The generative label model: a latent class, the rate at which each voter
   fires in each class, and the voters' correlations within a class, fitted by
   expectation-maximisation from the documents on which most voters fire. A
   vote's weight accounts for what correlated voters already said.
4. A logistic regression over the presence of words and word beginnings is
   trained on the posterior labels, and scores every whole text. The patterns
   are voters only.

Labels, lang, source and doc_id are no inputs of a score.

Defined cases: null text counts as empty and gets a score like any other;
documents without a label are scored; repeated labels of one doc_id count once,
as toxic if any is; without labels of both classes only the fixed lexicon
counts; repeated rows get equal scores; extra columns are ignored or passed
through; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panel_edit.llm.common import blocks, fresh, keep, ship, text_buffer, word_hash, words

#: Bound of the training sample: labelled documents of each class.
PER_CLASS = 8000
#: Words taken from the sample: at least this log-likelihood ratio and lift, in so many toxic documents.
MIN_RATIO, MIN_LIFT, MIN_DOCS = 12.0, 40, 4
#: Word beginnings, in bytes, that count beside the whole word: inflected words share them.
STEMS = (4, 5, 6)
#: Predicted toxic from this score.
THRESHOLD = 0.3
#: Voters made of the sample's words: each fires for the words of its group.
GROUPS = 12

#: Common insults, per language.
LEXICON = {
    "en": "idiot idiots moron morons stupid dumb loser losers trash garbage scum pathetic worthless disgusting clown filthy vermin "
          "retard bastard bitch asshole shit fuck fucking crap slut whore pig imbecile jerk freak hate kill".split(),
    "de": "idiot dumm dummkopf arschloch scheisse scheiße abschaum versager wertlos widerlich hurensohn schlampe trottel depp".split(),
    "fr": "idiot idiote imbécile connard connasse salope merde putain ordure minable dégoûtant crétin abruti racaille".split(),
    "es": "idiota imbécil estúpido estúpida basura mierda puta cabrón asqueroso patético inútil escoria payaso perdedor".split(),
}
PATTERNS = {
    "masked": re.compile(r"\b\w{1,2}[*@#$]{2,}\w*\b"),
    "addressed": re.compile(r"\byou(?:'re| are)? (?:\w+ ){0,2}(?:" + "|".join(LEXICON["en"]) + r")\b"),
    "shouting": re.compile(r"(?:\b[A-ZÀ-Ý]{4,}\b[!?., ]*){4}"),
}
_FILTER_BITS = 18


@dataclass
class Model:
    """The linear classifier: weights of words and word beginnings (by sorted hash), and the bias."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    rates: dict = field(default_factory=dict)  # what the label model found, for reports

    def __post_init__(self):
        order = np.argsort(self.hashes)
        self.hashes, self.weights = self.hashes[order], self.weights[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score of each of consecutive lower-cased texts."""
        n = len(offsets) - 1
        h, row = words(data, offsets, STEMS)
        maybe = np.flatnonzero(self.filter[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        h, row = h[maybe], row[maybe]
        at = np.minimum(np.searchsorted(self.hashes, h), max(len(self.hashes) - 1, 0))
        hit = self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool)
        pairs = np.unique(row[hit] * max(len(self.hashes), 1) + at[hit])  # presence: a word counts once
        size = max(len(self.hashes), 1)
        logit = np.bincount(pairs // size, self.weights[pairs % size] if len(self.weights) else None, n) + self.bias
        return np.round(1 / (1 + np.exp(-np.clip(logit, -30, 30))), 9)


def labelled_ids(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, y): the labelled rows that aren't held out, once each."""
    return (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).cast("int").alias("y"))
            .where(F.col("y").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y")))


def class_counts(labels: DataFrame, column: str) -> DataFrame:
    """(y, n): labelled rows of each class that aren't held out."""
    return labelled_ids(labels, column).groupBy("y").agg(F.count(F.lit(1)).alias("n"))


def training_ids(labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """(doc_id, y): up to ``per_class`` labelled rows of each class that aren't held out."""
    rows = labelled_ids(labels, column)
    take = [rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    return take[0].unionByName(take[1])


def held_out(doc_id):
    """Rows whose labels are kept for evaluation."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _sample_rows(batches):
    """Distinct hashes of the words and word beginnings, of the words alone, fired patterns, and a digest of the words, of the sampled texts."""
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"), lower=True)
        lists, own, fired = [], [], []
        for i, j in blocks(offsets):
            piece, ends = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            whole = words(piece, ends)
            for out, (h, row) in ((lists, words(piece, ends, STEMS)), (own, (whole[0], whole[3]))):
                h = h[np.argsort(row, kind="stable")]
                cut = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=j - i))])
                out += [np.unique(h[a:b]).view(np.int64) for a, b in zip(cut[:-1], cut[1:])]
        for t in batch.column("text").to_pylist():
            low = (t or "").lower()
            fired.append([int(bool(p.search(t or "" if name == "shouting" else low))) for name, p in PATTERNS.items()])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("y"), pa.array(lists, pa.list_(pa.int64())), pa.array(own, pa.list_(pa.int64())),
             pa.array(fired, pa.list_(pa.int32())), pa.array([hashlib.sha256(h.tobytes()).digest() for h in own], pa.binary())],
            ["doc_id", "y", "words", "own", "fired", "copy"])


def log_ratio(a, b, toxic: float, clean: float):
    """Log-likelihood ratio of a word in ``a`` of the toxic and ``b`` of the clean documents."""
    def part(x, n, total):
        expected = (a + b) * n / total
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    total = toxic + clean
    return 2 * (part(a, toxic, total) + part(b, clean, total)
                + part(toxic - a, toxic * (total - a - b) / (a + b), total) + part(clean - b, clean * (total - a - b) / (a + b), total))


class LabelModel:
    """Latent class, firing rates of the voters in each class, and their correlations within a class.

    A voter counts by ``1 / (1 + sum of its squared correlations with the others)``:
    alone fully, two that always agree half each. Given the class, the votes so
    weighted are independent; rates, correlations and posterior are fitted in turn.
    """

    def __init__(self, votes: np.ndarray, start: np.ndarray, prior: float, rounds: int = 200):
        x = votes.astype(float)
        p = np.clip(start.astype(float), 0.05, 0.95)
        mean = x.mean(axis=0)
        for _ in range(rounds):
            self.toxic = np.clip((p @ x + mean) / (p.sum() + 1), 1e-4, 1 - 1e-4)
            self.clean = np.clip(((1 - p) @ x + mean) / ((1 - p).sum() + 1), 1e-4, 1 - 1e-4)
            r1, r0 = x - self.toxic, x - self.clean
            within = ((r1 * p[:, None]).T @ r1 + (r0 * (1 - p)[:, None]).T @ r0) / len(x)
            spread = np.sqrt(np.maximum(np.diag(within), 1e-9))
            self.correlation = np.round(within / spread[:, None] / spread, 12)  # equal voters weigh the same, however the sums were added
            self.weights = 1 / np.maximum((self.correlation ** 2).sum(axis=1), 1)
            new = self.posterior_of(x, prior)
            done = np.abs(new - p).max() < 1e-6
            p = new
            if done:
                break
        self.posterior = p

    def posterior_of(self, x: np.ndarray, prior: float) -> np.ndarray:
        """Posterior of the toxic class of rows of votes."""
        fired, silent = np.log(self.toxic / self.clean), np.log((1 - self.toxic) / (1 - self.clean))
        logit = x @ (self.weights * (fired - silent)) + (self.weights * silent).sum() + np.log(prior / (1 - prior))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def logistic(rows: np.ndarray, columns: np.ndarray, n: int, width: int, target: np.ndarray, weight: np.ndarray, rounds: int = 600, l2: float = 2e-5):
    """Logistic regression on sparse presence features against soft targets (Adam, full batch)."""
    w, b = np.zeros(width), float(np.log((weight @ target + 1e-6) / (weight @ (1 - target) + 1e-6)))
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0
    total = weight.sum()
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, w[columns], n) + b, -30, 30)))
        e = weight * (p - target) / total
        g, gb = np.bincount(columns, e[rows], width) + l2 * w, e.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w -= 0.1 * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= 0.1 * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return w, b


def fixed_model() -> Model:
    """The classifier where there is nothing to learn from: the fixed lexicon."""
    h = np.array(sorted({word_hash(w) for ws in LEXICON.values() for w in ws}), np.uint64)
    return Model(h, np.full(len(h), 2.0), -2.0)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """The classifier, from a bounded sample of labelled documents."""
    ship(docs.sparkSession)
    ids = training_ids(labels, "toxic", per_class)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The sample is bounded by 2 * per_class rows of two numbers.
    sample = keep(texts.join(F.broadcast(ids), "doc_id").mapInArrow(_sample_rows, "doc_id bigint, y int, words array<bigint>, own array<bigint>, fired array<int>, copy binary"))
    # Texts of the same words count once; as few ids as the sample has are broadcast.
    once = sample.groupBy("y", "copy").agg(F.min("doc_id").alias("doc_id"))
    sample = sample.join(F.broadcast(once), ["y", "copy", "doc_id"], "left_semi")
    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return fixed_model()
    counts = (sample.select("y", F.explode("words").alias("h")).groupBy("h").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
              .where((F.col("a") >= MIN_DOCS) & (F.col("a") * clean > MIN_LIFT * F.col("b") * toxic)))
    found = (counts.withColumn("ratio", log_ratio(F.col("a"), F.col("b"), float(toxic), float(clean)))
             .where(F.col("ratio") >= MIN_RATIO).select("h").collect())  # as many as the bounded sample has
    mined = np.array([r.h for r in found], np.int64).view(np.uint64)
    lexicon = {lang: {word_hash(w) for w in ws} for lang, ws in LEXICON.items()}
    vocabulary = np.array(sorted({*map(int, mined), *(h for hs in lexicon.values() for h in hs)}), np.uint64)
    # A text of the numbers, which the optimizer turns into one constant array.
    listed = F.split(F.lit(",".join(map(str, vocabulary.view(np.int64)))), ",").cast("array<bigint>")
    present = sample.select("doc_id", F.struct("y", F.array_intersect("words", listed).alias("words"), F.array_intersect("own", listed).alias("own"), "fired").alias("r"))
    # One row per doc_id: at most 2 * per_class of them, in an order that no partitioning changes.
    present = [r.r for r in sorted(present.groupBy("doc_id").agg(F.min("r").alias("r")).collect(), key=lambda r: r.doc_id)]
    y = np.array([r.y for r in present])
    toxic, clean = int((y > 0).sum()), int((y == 0).sum())
    rows = np.repeat(np.arange(len(present)), [len(r.words) for r in present])
    held = np.array([h for r in present for h in r.words], np.int64).view(np.uint64)
    columns = np.searchsorted(vocabulary, held)
    fired = np.array([r.fired for r in present])

    is_mined = np.isin(vocabulary, mined)
    group = (vocabulary % np.uint64(GROUPS)).astype(int)
    n = len(present)
    # Voters look at words alone: a word's beginnings would say the same again.
    own_rows = np.repeat(np.arange(n), [len(r.own) for r in present])
    own = np.searchsorted(vocabulary, np.array([h for r in present for h in r.own], np.int64).view(np.uint64))
    voters = {f"words {g}": np.bincount(own_rows, (is_mined & (group == g))[own], n) > 0 for g in range(GROUPS)}
    for lang, hs in lexicon.items():
        member = np.isin(vocabulary, np.array(sorted(hs), np.uint64))
        voters[f"lexicon {lang}"] = np.bincount(own_rows, member[own], n) > 0
    voters |= {name: fired[:, k] > 0 for k, name in enumerate(PATTERNS)}
    names = [k for k, v in voters.items() if 0 < v.sum() < n]
    if not names:
        return fixed_model()
    votes = np.column_stack([voters[k] for k in names])
    share = votes.mean(axis=1)
    model = LabelModel(votes, (share > 0) & (share >= np.sort(share)[-toxic]), toxic / n)
    # The sample takes both classes alike: weights restore the labels' shares.
    shares = {r.y: r.n for r in class_counts(labels, "toxic").collect()}
    weight = np.where(y > 0, shares[1] / toxic, shares[0] / clean)
    w, b = logistic(rows, columns, n, len(vocabulary), model.posterior, weight)
    return Model(vocabulary, w, b, {k: (float(t), float(c)) for k, t, c in zip(names, model.toxic, model.clean)})


def with_score(docs: DataFrame, model: Model, column: str) -> DataFrame:
    """``docs`` and, as ``column``, the score of each whole text."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"), lower=True)
            found = [model.scores(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in blocks(offsets)]
            yield batch.append_column(column, pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64()))

    slim = docs.withColumn("text", F.col("text").cast("string"))
    return slim.mapInArrow(run, T.StructType([*slim.schema.fields, T.StructField(column, T.DoubleType())]))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels)
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return with_score(slim, model, "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that are predicted toxic."""
    column = fresh(docs, "_score")
    return with_score(docs, fit(docs, labels), column).where(F.col(column) < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
