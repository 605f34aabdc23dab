"""Quality rules: counts of each text, and a hashed n-gram likelihood ratio.

Base rules look at one text: its words, symbols, repeated lines and the words
that lie in a repeated window of three. The verdict compares two multinomials
over hashed n-grams (words and pairs of words of the lower-cased text, ``1 <<
BUCKET_BITS`` buckets): the trusted target, texts whose label says good
quality, and the raw corpus, all texts. A text's score is the sum of its
n-grams' log-likelihood ratios, divided by their number; it is kept from a
threshold on. Ratios are whole millionths, so sums do not depend on their order,
and every text is decided by its own content alone.

The raw counts cover every text. Labels are read by crc32(doc_id) modulo 4: rows
of remainder 0 and 1 give the target, rows of 3 the threshold (a text whose own
n-grams are in the target scores too high to set it), rows of 2 are held out.
The target counts cover every trusted document, and the threshold is fitted on
every labelled document of its remainder that passes the base rules: of the cuts
halfway between two neighbouring scores, the one at which the share of good
documents above plus that of bad documents below is largest (of equals, the lowest).

All of it is DataFrame expressions: n-grams are hashed by higher-order functions
inside a row; only texts that can be in the target are joined with the labels,
the others never leave their task. The counts of the buckets, of
fixed number, meet at the driver, and their ratios go out as one literal array. Nothing is grouped by document.
The cuts are compared score by score, in groups of ``CELL`` neighbouring scores;
of each group, one row comes to a single task.

Defined cases: a null text has no words; a text without words scores 0 and
fails the base rules; null ids or labels of documents take no part in the
target; repeated rows count as often as they stand; labels that contradict each
other for one doc_id count as their least; without labels of both classes
nothing but the base rules decides; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panel_edit.llm.common import keep

BUCKET_BITS = 16
#: Base rules: fewer words fail, and so do texts with over this share (in hundredths) of repeated words.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Bits of a window's key that hold its place in the text (no string of Spark has so many words).
PLACE_BITS = 30
#: Ratios are counted in these parts.
UNIT = 1_000_000
#: Scores (whole ``UNIT``s) that the threshold's running sums go through in one group.
CELL = 1_000

_SPACES, _NO_SYMBOLS = r"[\x20\x09-\x0D]+", "[^#*$%&|<>]+"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (lambdas would compute it again for each element)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text, ``[^\\x20\\x09-\\x0D]+``."""
    return F.array_remove(F.split(text, _SPACES), "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def window_keys(hashes: Column) -> Column:
    """One whole number per window of three words: hash above, place below ``PLACE_BITS``."""
    key = lambda x, i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), x).bitwiseAND(F.lit(-1 << PLACE_BITS)).bitwiseOR(i.cast("bigint"))
    return F.when(F.size(hashes) > 2, F.transform(F.slice(hashes, F.lit(3), F.size(hashes)), key)).otherwise(F.array().cast("array<bigint>"))


def repeated_words(own: Column, keys: Column) -> Column:
    """Words that lie in a window of three which occurs twice or more.

    ``keys`` are sorted, so windows whose hashes agree are neighbours; those
    windows alone are compared as strings, sorted once more.
    """
    place = lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
    agree = lambda x, i: F.shiftright(x, PLACE_BITS) == F.shiftright(F.get(keys, i), PLACE_BITS)
    maybe = F.filter(keys, lambda x, i: F.coalesce(agree(x, i + 1), F.lit(False)) | F.coalesce(agree(x, i - 1), F.lit(False)))
    windows = F.transform(maybe, lambda x: F.struct(F.concat_ws(" ", F.slice(own, place(x) + 1, F.lit(3))).alias("w"), place(x).alias("i")))
    same = lambda s, i, x: F.coalesce(F.get(s, i)["w"] == x["w"], F.lit(False))
    return let(F.sort_array(windows), lambda s: let(
        F.filter(s, lambda x, i: same(s, i - 1, x) | same(s, i + 1, x)),
        lambda r: F.size(F.array_distinct(F.flatten(F.transform(r, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))))).cast("bigint")


def buckets(hashes: Column) -> Column:
    """The buckets of a text's words and pairs of words, from the hashes of its words."""
    place = lambda h: F.pmod(h, F.lit(1 << BUCKET_BITS)).cast("int")
    pairs = F.transform(F.slice(hashes, F.lit(2), F.size(hashes)), lambda x, i: place(F.xxhash64(F.get(hashes, i), x)))
    return F.concat(F.transform(hashes, place), F.when(F.size(hashes) > 1, pairs).otherwise(F.array().cast("array<int>")))


def hashed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text, its words w and their hashes h, behind the columns ``more``. Columns that a lambda reads are columns of their own, computed once."""
    rows = docs.select(*more, "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.select(*more, "doc_id", "text", words(F.col("text")).alias("w"))
    return rows.select(*more, "doc_id", "text", "w", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the buckets of its n-grams, and the counts and verdict of the base rules."""
    rows = hashed(docs).select("doc_id", "text", "w", "h", F.sort_array(window_keys(F.col("h"))).alias("keys"))
    rows = rows.select("doc_id", F.size("w").cast("bigint").alias("n_words"),
                       F.length(F.regexp_replace("text", _SPACES, "")).cast("bigint").alias("word_chars"),
                       F.length(F.regexp_replace("text", _NO_SYMBOLS, "")).cast("bigint").alias("n_symbols"),
                       duplicate_lines(F.col("text")).alias("n_dup_lines"), repeated_words(F.col("w"), F.col("keys")).alias("n_repeat_words"),
                       buckets(F.col("h")).alias("buckets"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    return rows.withColumn("base_failed", failed)


def remainder(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 4."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4))


def labelled(labels: DataFrame, remainders: tuple[int, ...]) -> DataFrame:
    """(doc_id, trusted) of all labelled documents of these remainders."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & remainder(F.col("doc_id")).isin(*remainders))
    return rows.groupBy("doc_id").agg((F.min("quality") == 1).alias("trusted"))


def ratios(docs: DataFrame, labels: DataFrame, remainders: tuple[int, ...]) -> Column:
    """Log-likelihood ratio of each bucket, target (of these remainders) against raw (both smoothed by one), in ``UNIT``s: a literal array (the optimizer folds it), of one size at any input."""
    rows = docs.select("doc_id", "text")
    chosen = labelled(labels, remainders).filter("trusted")
    able = F.coalesce(remainder(F.col("doc_id")).isin(*remainders), F.lit(False))
    # A shuffled join at any size: the target's documents grow with the corpus, and their texts need no sort.
    marked = rows.filter(able).join(chosen.hint("shuffle_hash"), "doc_id", "left").unionByName(rows.filter(~able).withColumn("trusted", F.lit(None).cast("boolean")))
    marked = hashed(marked, "trusted").select("trusted", buckets(F.col("h")).alias("buckets"))
    counts = (marked.select("trusted", F.explode_outer("buckets").alias("bucket"))
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("target")))
    found = {r["bucket"]: (r["raw"], r["target"]) for r in counts.collect() if r["bucket"] is not None}
    size = 1 << BUCKET_BITS
    raw, target = (sum(x[i] for x in found.values()) + size for i in (0, 1))
    each = (found.get(b, (0, 0)) for b in range(size))
    listed = ",".join(str(round(UNIT * (math.log((t + 1) / target) - math.log((r + 1) / raw)))) for r, t in each)
    return F.split(F.lit(listed), ",").cast("array<bigint>")


def threshold(scored: DataFrame, chosen: DataFrame) -> int | None:
    """The cut between the good and the bad documents of ``chosen`` (None without both)."""
    rows = scored.filter(~F.col("base_failed")).select("doc_id", "score").join(chosen, "doc_id")
    count = lambda own: F.count(F.when(own, 1))
    seen = keep(rows.groupBy("score").agg(count(F.col("trusted")).alias("good"), count(~F.col("trusted")).alias("bad"))
                .withColumn("cell", F.floor(F.col("score") / CELL)))
    # What lies below each score: below its cell, and below it in its cell.
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    below = lambda name, window: F.coalesce(F.sum(name).over(window), F.lit(0))
    cells = seen.groupBy("cell").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("score").alias("top"))
    cells = cells.select("cell", below("good", before).alias("good_before"), below("bad", before).alias("bad_before"), F.max("top").over(before).alias("top_before"))
    within = Window.partitionBy("cell").orderBy("score")
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    steps = seen.join(cells, "cell").select(
        "score", (F.col("good_before") + below("good", earlier)).alias("lost"), (F.col("bad_before") + below("bad", earlier)).alias("stopped"),
        F.coalesce(F.lag("score").over(within), F.col("top_before")).alias("last"))
    total = seen.agg(F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad")).filter("all_good > 0 AND all_bad > 0")
    gain = (F.col("all_good") - F.col("lost")) / F.col("all_good") + F.col("stopped") / F.col("all_bad")
    best = steps.crossJoin(F.broadcast(total)).agg(F.max(F.struct(gain.alias("gain"), (-F.col("score")).alias("low"), "last")).alias("best")).first()["best"]
    if best is None:
        return None
    return -best["low"] if best["last"] is None else (best["last"] - best["low"]) // 2 + 1


def with_score(rows: DataFrame, weights: Column) -> DataFrame:
    """``rows`` with the length-normalised ratio of each text, in ``UNIT``s (whole; 0 for a text without words)."""
    total = F.aggregate("buckets", F.lit(0).cast("bigint"), lambda acc, b: acc + F.get(weights, b))
    n = F.size("buckets")
    return rows.withColumn("score", F.when(n > 0, F.floor(total / n)).otherwise(0).cast("bigint"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_words, the base counts, base_failed, kept and score of every document."""
    # Kept, since a filter on a computed column would compute that column once more.
    scored = keep(with_score(base_rules(docs), ratios(docs, labels, (0, 1))).drop("buckets"))
    cut = threshold(scored, labelled(labels, (3,)))
    kept = ~F.col("base_failed") & (F.lit(True) if cut is None else F.col("score") >= cut)
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "score")
