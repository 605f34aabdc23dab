"""Phrase collocation mining by Rabin-Karp fingerprints.

Texts are lower-cased (A to Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
into words ``[^\\x20\\x09]+``; everything is counted per language. Phrases are
mined length by length:

Equal texts of a language are one row with their number. Then:

1. A task takes a batch of texts, numbers its words exactly, hashes each
   distinct word and then every n-gram with prefix polynomials (two prefix sums
   give the hash of any run of words), and puts out (fingerprint, count). A
   shuffle on the fingerprint adds the counts; those that reach the least count
   are frequent. Words come first, then pairs, then three and four words: an
   n-gram is only counted where its words (its pairs) are frequent. No frequent
   phrase is lost, since no phrase is more frequent than a part of it and a
   clash only adds to a count. That test is one Bloom filter of
   ``1 << FILTER_BITS`` bits, of one size however much is counted: bits that
   clash let an n-gram through, never stop it.
2. The n-grams of a batch that pass the filter become *entries*: fingerprint,
   count and a pointer to an occurrence. Two n-grams of a batch that share a
   fingerprint are compared word by word and have an entry each.
3. The phrases are read from the text at their pointers and the counts are added
   again by (language, phrase), in the task and then in a shuffle: fingerprints
   that clash, in one batch or over many, fall apart there, and what only the
   filter let through is dropped. The counts are exact.

The pointers stay in the task, which holds the text: sent through the shuffle
and resolved by a join with the texts, they took over six times the input of disk.

The frequent phrases are scored by joins on (language, phrase), and the first
phrases of each language are picked in two steps, so that no task ranks a
whole language.

Defined cases: a null text is empty; a null language is ``und``; repeated rows
(also with one doc_id) all count; ties go by score, count and bytes of the
phrase; an empty table gives no rows; extra columns are ignored. A text of any
length is counted whole (a batch holds at least one text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panel_edit.llm.common import keep, mix, release, remove, scratch, ship, text_buffer

#: A candidate occurs so often at least and has so many words at most; so many phrases of a language are returned.
MIN_COUNT, MAX_WORDS, TOP = 30, 4, 2000
#: The score's factor, and the share (in hundredths) of a phrase's count at which a longer one replaces it.
SCALE, SUBSUMED = 2_000_000, 80
#: Bits of the filter of frequent fingerprints (16 MB), and where in a fingerprint its places in the filter are read.
FILTER_BITS, FILTER_SHIFTS = 27, (0, 18, 37)
#: Text bytes of a batch (a longer text is a batch of its own).
BATCH_BYTES = 6 << 20
#: Fingerprints that a task adds up before it puts them out.
MERGE_ROWS = 2 << 20
#: Phrases that a task hands over at a time.
OUT_ROWS = 1 << 16
#: Words hashed by one numpy step.
STEP = 1 << 20
#: Groups among which a language's phrases are ranked first.
RANK_GROUPS = 16
#: Partitions of texts that one task of the last pass reads, at most, and tasks a core below which none are joined.
JOINED_PARTS, CORE_TASKS = 16, 2
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: What a byte is: 0 of a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 9]] = 1
_KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2

#: Bases of the polynomials over bytes and over words (odd, so that they have inverses modulo 2**64).
_BASE_BYTES, _BASE_WORDS = 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93
_BYTE = np.random.default_rng(1103).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def run_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[first:last]`` for each pair: a polynomial that depends on the values alone, from two prefix sums."""
    up, down = powers(base, len(values)), powers(pow(base, -1, 1 << 64), len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return (sums[last] - sums[first]) * down[first]


def value_hashes(column: pa.Array) -> np.ndarray:
    """Hash of the bytes of each value of a binary or string column."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    out = np.empty(len(column), np.uint64)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + STEP, "right")) - 1)
        own = offsets[i:j + 1] - offsets[i]
        out[i:j] = run_hashes(_BYTE[data[offsets[i]:offsets[j]]], own[:-1], own[1:], _BASE_BYTES)
        i = j
    return mix(out + np.diff(offsets).astype(np.uint64))


class Words:
    """The words of a batch of texts: exact number, row and piece of each, and hashes of runs of them."""

    def __init__(self, texts: pa.Array, langs: pa.Array, copies: np.ndarray, bits: int = 64):
        self.copies = copies  # rows that each text stands for
        closed = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""), pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
        data, offsets = text_buffer(closed)
        kind = _KIND[data]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[1:] = kind == 0
        edge = np.flatnonzero(np.diff(inside))
        first, last = edge[0::2], edge[1::2]
        self.row = (np.searchsorted(offsets, first, "right") - 1).astype(np.int32)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[first]
        ends = np.zeros(len(first) + 1, np.int64)
        np.cumsum(last - first, out=ends[1:])
        own = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(_LOWER[data[kind == 0]])])
        coded = own.dictionary_encode()
        self.words, self.number = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        self.hash = value_hashes(coded.dictionary)[self.number] if len(first) else np.zeros(0, np.uint64)
        coded = pc.fill_null(langs.cast(pa.large_string()), UNKNOWN).dictionary_encode()
        self.langs, self.lang_of_row = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        self.lang_hash = value_hashes(coded.dictionary) if len(coded.dictionary) else np.zeros(0, np.uint64)
        self.mask = np.uint64((1 << bits) - 1)

    def runs(self, n: int) -> np.ndarray:
        """First word of each run of n words within a piece."""
        if len(self.piece) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[n - 1:] == self.piece[:len(self.piece) - n + 1])

    def fingerprints(self, at: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the runs of n words at ``at`` (ascending), with the language and n in them."""
        out = np.empty(len(at), np.uint64)
        for low in range(0, len(self.hash), STEP):
            i, j = np.searchsorted(at, [low, low + STEP])
            own = at[i:j] - low
            out[i:j] = run_hashes(self.hash[low:low + STEP + n], own, own + n, _BASE_WORDS)
        return mix(out + self.lang_hash[self.lang_of_row[self.row[at]]] * np.uint64(2 * n + 1)) & self.mask

    def spelled(self, count: np.ndarray, at: np.ndarray, n: int):
        """(count, phrase, language) of the runs of n words at the pointers ``at``."""
        phrase = self.words.take(pa.array(self.number[at]))
        for t in range(1, n):
            phrase = pc.binary_join_element_wise(phrase, self.words.take(pa.array(self.number[at + t])), pa.scalar(b" ", pa.large_binary()))
        return count, phrase.cast(pa.large_string()).cast(pa.string()), self.langs.take(pa.array(self.lang_of_row[self.row[at]])).cast(pa.string())

    def totals(self):
        """(words, empty phrase, language) of each language."""
        count = np.zeros(len(self.langs), np.int64)
        np.add.at(count, self.lang_of_row[self.row], self.copies[self.row])
        return count, pa.array([""] * len(count), pa.string()), self.langs.cast(pa.string())

    def entries(self, at: np.ndarray, fp: np.ndarray, n: int):
        """(fingerprint, count, first word of an occurrence) of each different run; equal fingerprints are compared word by word."""
        order = np.argsort(fp, kind="stable")
        at, fp = at[order], fp[order]
        weight = self.copies[self.row[at]]
        group = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]])) if len(fp) else np.zeros(0, np.int64)
        if not len(fp):
            return fp, weight, at
        of = np.repeat(at[group], np.diff(np.append(group, len(fp))))
        same = self.lang_of_row[self.row[at]] == self.lang_of_row[self.row[of]]
        for t in range(n):
            same &= self.number[at + t] == self.number[of + t]
        kept = np.add.reduceat(np.where(same, weight, 0), group)
        if same.all():
            return fp[group], kept, at[group]
        odd = np.flatnonzero(~same)
        keys = np.column_stack([fp[odd].view(np.int64), self.lang_of_row[self.row[at[odd]]], *(self.number[at[odd] + t] for t in range(n))])
        _, one, which = np.unique(keys, axis=0, return_index=True, return_inverse=True)
        more = np.zeros(len(one), np.int64)
        np.add.at(more, which.ravel(), weight[odd])
        return np.concatenate([fp[group], fp[odd[one]]]), np.concatenate([kept, more]), np.concatenate([at[group], at[odd[one]]])


def passing(bitmap: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Whether all bits of each fingerprint are set."""
    left = np.arange(len(fp))  # most fall out at the first place
    for shift in FILTER_SHIFTS:
        at = (fp[left] >> np.uint64(shift)) & np.uint64((1 << FILTER_BITS) - 1)
        left = left[(bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1]
    ok = np.zeros(len(fp), bool)
    ok[left] = True
    return ok


def chosen_runs(words: Words, length: int, parts: int | None, bitmap: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``length`` words and their fingerprints: all, those whose parts of ``parts`` words pass the filter, or (0 parts) that pass it themselves."""
    at = words.runs(length)
    if parts:
        inner = words.runs(parts)
        good = np.zeros(len(words.piece) + 1, bool)
        good[inner] = passing(bitmap, words.fingerprints(inner, parts))
        ok = good[at]
        for t in range(1, length - parts + 1):
            ok &= good[at + t]
        at = at[ok]
    fp = words.fingerprints(at, length)
    if parts == 0:
        ok = passing(bitmap, fp)
        at, fp = at[ok], fp[ok]
    return at, fp


def summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, count) pairs with equal fingerprints added."""
    fp, count = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(fp, kind="stable")
    fp, count = fp[order], count[order]
    group = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]])) if len(fp) else np.zeros(0, np.int64)
    return fp[group], np.add.reduceat(count, group) if len(fp) else count


def text_batches(batches: Iterator[pa.RecordBatch], limit: int, bits: int) -> Iterator[Words]:
    """The words of the texts, in batches of about ``limit`` bytes."""
    held, size = [], 0

    def flush():
        table = pa.Table.from_batches(held).combine_chunks()
        text, lang = (table[c].chunk(0) if table[c].num_chunks == 1 else table[c].combine_chunks() for c in ("text", "lang"))
        return Words(text, lang, table["copies"].to_numpy(), bits)

    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        done = 0
        while done < batch.num_rows:
            room = limit - size + (sizes[done - 1] if done else 0)
            upto = max(int(np.searchsorted(sizes, room, "right")), done + (not held))
            if upto > done:
                held.append(batch.slice(done, upto - done))
                size += int(sizes[upto - 1] - (sizes[done - 1] if done else 0))
                done = upto
            if done < batch.num_rows:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def counted(lengths: tuple[int, ...], parts: int | None, filt, bits: int):
    """For ``mapInArrow`` over (lang, text, copies): (fp, cnt), added up within the task as far as ``MERGE_ROWS`` allow."""
    limit, most = BATCH_BYTES, MERGE_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = filt.value if filt is not None else None
        held, size = [], 0

        def out(pair):
            return pa.RecordBatch.from_arrays([pa.array(pair[0].view(np.int64)), pa.array(pair[1].astype(np.int64))], ["fp", "cnt"])

        for words in text_batches(batches, limit, bits):
            for n in lengths:
                at, fp = chosen_runs(words, n, parts, bitmap)
                weight = words.copies[words.row[at]]
                once = weight == 1  # nearly all
                held += [np.unique(fp[once], return_counts=True), summed([(fp[~once], weight[~once])])]
                size += len(held[-1][0]) + len(held[-2][0])
            if size > most:
                held = [summed(held)]
                size = len(held[0][0])
                if size > most // 2:
                    yield out(held[0])
                    held, size = [], 0
        if held:
            yield out(summed(held))

    return run


def spelled(lengths: tuple[int, ...], filt, bits: int):
    """For ``mapInArrow`` over (lang, text, copies): (lang, phrase, cnt) of the runs that pass the filter, read at their pointers.

    The empty phrase counts the words of a language.
    """
    limit, most = BATCH_BYTES // 2, MERGE_ROWS // 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def added():
            table = pa.concat_tables(held).group_by(["lang", "phrase"], use_threads=False).aggregate([("cnt", "sum")])
            held.clear()
            pa.default_memory_pool().release_unused()
            return table.select(["lang", "phrase", "cnt_sum"]).rename_columns(["lang", "phrase", "cnt"])

        for words in text_batches(batches, limit, bits):
            for n in (0, *lengths):
                count, phrase, lang = words.spelled(*words.entries(*chosen_runs(words, n, 0, filt.value), n)[1:], n) if n else words.totals()
                held.append(pa.table({"lang": lang, "phrase": phrase, "cnt": pa.array(count.astype(np.int64))}))
                size += len(count)
            if size > most:
                held = [added()]
                size = held[0].num_rows
                if size > most * 3 // 4:
                    yield from held[0].combine_chunks().to_batches(OUT_ROWS)
                    held, size = [], 0
        if held:
            yield from added().combine_chunks().to_batches(OUT_ROWS)

    return run


def frequent(docs: DataFrame, lengths: tuple[int, ...], parts: int | None, filt, min_count: int, bits: int) -> DataFrame:
    """(fp) of the runs of ``lengths`` words that reach the least count, kept."""
    counts = docs.mapInArrow(counted(lengths, parts, filt, bits), "fp bigint, cnt bigint")
    return keep(counts.groupBy("fp").agg(F.sum("cnt").alias("cnt")).filter(F.col("cnt") >= min_count).select("fp"))


def set_bits(bitmap: np.ndarray, fps: DataFrame) -> np.ndarray:
    """The filter with the bits of more fingerprints: at most ``1 << (FILTER_BITS - 6)`` rows come to the driver, at any input."""
    places = F.array(*[F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) for shift in FILTER_SHIFTS])
    slots = (fps.select(F.explode(places).alias("at")).groupBy(F.shiftright("at", 6).alias("slot"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow())
    out = bitmap.copy()
    out[slots["slot"].to_numpy()] |= slots["bits"].to_numpy().view(np.uint64)
    return out


def last_tasks(rows: DataFrame) -> int:
    """Tasks of the last pass: each puts out a frequent phrase once, so few long ones put out far fewer rows than many short ones (what a task holds is bounded)."""
    return max(CORE_TASKS * rows.sparkSession.sparkContext.defaultParallelism, -(-rows.rdd.getNumPartitions() // JOINED_PARTS))


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, bits: int = 64) -> DataFrame:
    """(lang, phrase, words, f): all words and phrases of up to ``max_words`` words that occur ``min_count`` times, kept.

    The row with an empty phrase (``words`` 0) counts all words of its language.
    ``bits`` narrows the fingerprints (for tests).
    """
    spark = docs.sparkSession
    ship(spark)
    # Equal texts are read once, with their number: their phrases then come from one task.
    folder = scratch(spark, "collocations")
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts.groupBy("lang", "text").agg(F.count(F.lit(1)).alias("copies")).write.parquet(folder)
    rows = spark.read.parquet(folder)
    release(spark)
    bitmap, filt = np.zeros(1 << (FILTER_BITS - 6), np.uint64), None
    for parts, lengths in ((None, (1,)), (1, (2,)), (2, tuple(range(3, max_words + 1)))):
        if lengths and lengths[0] <= max_words:
            bitmap = set_bits(bitmap, frequent(rows, lengths, parts, filt, min_count, bits))
            filt = spark.sparkContext.broadcast(bitmap)
            release(spark)  # the disk holds one level's shuffle at a time
    found = rows.coalesce(last_tasks(rows)).mapInArrow(spelled(tuple(range(1, max_words + 1)), filt, bits), "lang string, phrase string, cnt bigint")
    counts = found.groupBy("lang", "phrase").agg(F.sum("cnt").alias("f"))
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    counts = keep(counts.withColumn("words", words).filter((F.col("f") >= min_count) | (F.col("words") == 0)))
    remove(spark, folder)
    return counts


def _exact(column) -> F.Column:
    """A count as a decimal, whose products are exact."""
    return F.col(column).cast("decimal(20,0)")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, bits: int = 64) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score (see the module's text)."""
    counts = phrase_counts(docs, min_count, bits=bits)
    words = F.split("phrase", " ")
    phrases = counts.filter("words > 1").select("lang", "phrase", F.col("f").alias("a"), "words", words.alias("w"))

    k = F.col("k")
    cuts = phrases.select("lang", "phrase", "a", "words", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice("w", k + 1, F.col("words") - k), " ").alias("right"))
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    score = F.expr(f"(cast(a as decimal(20,0)) * {SCALE}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = (cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")))

    inner = F.expr("array_distinct(flatten(transform(sequence(2, words - 1), s -> "
                   "transform(sequence(1, words - s + 1), i -> array_join(slice(w, i, s), ' ')))))")
    longer = (phrases.filter("words > 2").select("lang", "a", F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    best = (scored.join(longer, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * SUBSUMED))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    first = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", group).orderBy(*order))).filter(F.col("rank") <= top)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    total = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return first.join(total, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
