"""Collocations and quality rules against brute force on small tables of edge cases."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from panel_edit.llm import collocations, hard_negatives, quality_rules

ASCII_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus():
    """Rows of (doc_id, text, lang): few words, so that many phrases repeat, with blanks, marks, nulls, long and repeated texts."""
    rnd = random.Random(5)
    vocabulary = ["the", "Ä", "é'a", "x" * 40, "ab", "a", "b", " z", "İ", "kk"]

    def text(n):
        return "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r", "\x0b"]) for _ in range(n))

    rows = [(i, text(rnd.randint(0, 60)), rnd.choice(["en", "fr", None])) for i in range(60)]
    hot = "the ab the ab a b"
    rows += [(100 + i, hot.upper() if i % 2 else hot, "en") for i in range(40)]
    return [*rows, (500, None, "en"), (501, "", None), (502, " \t.;", "xx"), (503, text(4000), "fr"), (504, "und " * 50, "und"), rows[0], (None, "a b", "en")]


def phrases_by_hand(rows, least, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(ASCII_UPPER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    longer = Counter()
    for (lang, w), a in found.items():
        for s in range(2, len(w)):
            for i in range(len(w) - s + 1):
                longer[lang, w[i:i + s]] = max(longer[lang, w[i:i + s]], a)
    by = defaultdict(list)
    for (lang, w), a in found.items():
        if 100 * longer[lang, w] < 80 * a:
            score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            by[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, le, r, n[lang], -s) for lang, own in by.items() for i, (s, a, p, le, r) in enumerate(sorted(own)[:top]))


@pytest.mark.parametrize("bits", [64, 5], ids=["sound", "clashing"])
def test_collocations_equal_counting_by_hand(spark, bits, monkeypatch):
    """Also with five-bit fingerprints, under which most n-grams clash, and with batches of a few texts."""
    rows = corpus()
    monkeypatch.setattr(collocations, "BATCH_BYTES", 500)
    monkeypatch.setattr(collocations, "MERGE_ROWS", 90)
    table = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], "doc_id bigint, text string, lang string, row int, phrase string, fp int, n int").repartition(3)
    got = collocations.collocations(table, min_count=12, top=25, bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(rows, 12, 25)


def test_collocations_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert collocations.collocations(none).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, ". ,", "en")], none.schema)
    assert collocations.collocations(blank).count() == 0


def test_a_phrase_is_put_out_by_few_tasks(spark, monkeypatch):
    """Over 64 partitions of texts that all hold the same phrases."""
    made, original = spark.sparkContext.accumulator(0), collocations.spelled

    def counting(*args):
        run = original(*args)

        def counted(batches):
            for batch in run(batches):
                made.add(batch.num_rows)
                yield batch

        return counted

    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "100000"}
    before = {k: spark.conf.get(k) for k in settings}
    monkeypatch.setattr(collocations, "spelled", counting)
    docs = spark.createDataFrame([(i, f"alpha beta gamma, n{i}", "en") for i in range(1500)], "doc_id bigint, text string, lang string")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = {(r.phrase, r.f) for r in collocations.phrase_counts(docs).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == {("", 6000), *((x, 1500) for x in ("alpha", "beta", "gamma", "alpha beta", "beta gamma", "alpha beta gamma"))}
    assert made.value <= 7 * 2 * spark.sparkContext.defaultParallelism < 7 * 64


def test_entries_within_a_batch_tell_clashing_runs_apart():
    import numpy as np
    import pyarrow as pa

    words = collocations.Words(pa.array(["a b a b c", "a b"]), pa.array(["en", None]), np.array([1, 3]), bits=0)
    at = words.runs(2)
    fp, count, first = words.entries(at, words.fingerprints(at, 2), 2)
    got = Counter({(int(words.lang_of_row[words.row[i]]), *words.number[[i, i + 1]]): int(c) for i, c in zip(first, count, strict=True)})
    a, b, c = 0, 1, 2
    assert set(fp) == {0} and got == {(0, a, b): 2, (0, b, a): 1, (0, b, c): 1, (1, a, b): 3}


def base_by_hand(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = Counter(x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), sum(c - 1 for c in lines.values()), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def grams(text):
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(h, h[1:])]
    return [signed(x) % (1 << quality_rules.BUCKET_BITS) for x in h + pairs]


def judged(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id bigint, text string, w string, buckets int, score int").repartition(3)
    got = quality_rules.judge(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, trusted int"))
    return [tuple(r) for r in got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score").collect()]


def good_and_bad(seed=3, n=120):
    rnd = random.Random(seed)
    good, bad = ([rnd.choice(letters) + str(i) for i in range(80)] for letters in ("abc", "xyz"))
    return [(i, " ".join(rnd.choice(good if i % 2 else bad) for _ in range(rnd.randint(50, 120)))) for i in range(n)]


def test_quality_rules_equal_brute_force(spark):
    import zlib

    rows = good_and_bad()
    line = "the same line & again"
    long = " ".join(f"w{i % 4999}" for i in range(30000))
    odd = [(1000, None), (1001, ""), (1002, " \t\r\x0b\x0c\n"), (1003, "\n".join([line, line, " ", " ", "other", line])), (1004, "a b c " * 40),
           (1005, "é ß 漢字 #*$%&|<>"), (1006, "a b c d a b c"), (1007, long), (1008, "a a a"), (1009, "a a a a"), (None, "x y z"), rows[0], rows[0]]
    labels = [(i, i % 2, 0, 1) for i, _ in rows] + [(None, 1, 0, 1), (1007, None, 0, 1), (0, 1, 1, 1), (77777, 1, 0, 0)]
    every = rows + odd
    got = judged(spark, every, labels)

    part = lambda i: zlib.crc32(str(i).encode()) % 4
    quality = {i: min(q for j, q, *_ in labels if j == i) for i, q, *_ in labels if i is not None and q is not None}
    raw, target = Counter(), Counter()
    for i, t in every:
        raw.update(grams(t))
        if i is not None and quality.get(i) == 1 and part(i) in (0, 1):
            target.update(grams(t))
    size = 1 << quality_rules.BUCKET_BITS
    a, b = sum(target.values()) + size, sum(raw.values()) + size
    ratio = {g: round(1_000_000 * (math.log((target[g] + 1) / a) - math.log((raw[g] + 1) / b))) for g in raw}
    score = lambda t: sum(map(ratio.get, grams(t))) // len(grams(t)) if grams(t) else 0
    cut_rows = sorted((score(t), quality[i] == 1) for i, t in every if i is not None and quality.get(i) is not None and part(i) == 3 and not base_by_hand(t)[-1])
    best, cut = -1, None
    for k, (s, _) in enumerate(cut_rows):
        if k == 0 or s != cut_rows[k - 1][0]:
            above = sum(g for x, g in cut_rows if x >= s) / sum(g for _, g in cut_rows)
            below = sum(not g for x, g in cut_rows if x < s) / sum(not g for _, g in cut_rows)
            if above + below > best:
                best, cut = above + below, s if k == 0 else (s + cut_rows[k - 1][0]) // 2 + 1
    want = [(i, *base_by_hand(t), not base_by_hand(t)[-1] and score(t) >= cut, score(t)) for i, t in every]
    assert sorted(map(str, got)) == sorted(map(str, want))
    held = [(r[0], r[7]) for r in got if r[0] is not None and r[0] < 120 and part(r[0]) == 2 and not r[6]]
    assert len(held) > 15 and all(kept == (i % 2 == 1) for i, kept in held)


def test_quality_rules_count_every_labelled_document(spark):
    """Far more trusted documents than any sample of fixed size would hold."""
    import zlib

    rows = [(i, f"w{i * i % 11} v") for i in range(44000)]
    got = {r[0]: r[8] for r in judged(spark, rows, [(i, 1, 0, 0) for i, _ in rows])}
    raw, target, all_grams = Counter(), Counter(), {t: grams(t) for t in {t for _, t in rows}}
    for i, t in rows:
        raw.update(all_grams[t])
        if zlib.crc32(str(i).encode()) % 4 < 2:
            target.update(all_grams[t])
    size = 1 << quality_rules.BUCKET_BITS
    a, b = sum(target.values()) + size, sum(raw.values()) + size
    ratio = {g: round(1_000_000 * (math.log((target[g] + 1) / a) - math.log((raw[g] + 1) / b))) for g in raw}
    assert a - size > 3 * 20_000 and got == {i: sum(map(ratio.get, all_grams[t])) // len(all_grams[t]) for i, t in rows}
    labels = spark.createDataFrame([(i, i % 2) for i in range(90000)], "doc_id bigint, quality int")
    found = {tuple(r) for r in quality_rules.labelled(labels, (3,)).collect()}
    assert found == {(i, i % 2 == 1) for i in range(90000) if zlib.crc32(str(i).encode()) % 4 == 3}


@pytest.mark.parametrize("spread", [3, 900, 2_000_000], ids=["ties", "one cell", "many cells"])
def test_threshold_equals_trying_every_cut(spark, spread):
    rnd = random.Random(spread)
    rows = [(i, rnd.randint(-spread, spread) + (i % 3 == 0) * spread // 2, i % 3 == 0) for i in range(700)]
    scored = spark.createDataFrame([(i, s, i % 50 == 7) for i, s, _ in rows], "doc_id bigint, score bigint, base_failed boolean").repartition(3)
    chosen = spark.createDataFrame([(i, t) for i, _, t in rows if i % 7], "doc_id bigint, trusted boolean")
    seen = [(s, t) for i, s, t in rows if i % 7 and i % 50 != 7]
    good = sum(t for _, t in seen)
    share = lambda c: sum(t for s, t in seen if s >= c) / good + sum(not t for s, t in seen if s < c) / (len(seen) - good)
    scores = sorted({s for s, _ in seen})
    best = max(scores, key=lambda c: (share(c), -c))
    at = scores.index(best)
    assert quality_rules.threshold(scored, chosen) == ((best + scores[at - 1]) // 2 + 1 if at else best)
    assert quality_rules.threshold(scored, chosen.filter("trusted")) is None


def test_quality_rules_without_labels_or_rows(spark):
    got = judged(spark, [(1, "a b"), (2, " ".join(f"w{i}" for i in range(60)))], [])
    assert sorted(r[7] for r in got) == [False, True]
    assert judged(spark, [], [(1, 1, 0, 1)]) == []


def mined_by_hand(rows, every):
    by = {}
    for i, v, y in rows:
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            row = ((y + 1) % 10 if i % 7 == 0 else y, [math.floor(x * 256) for x in v])
            by[i] = min(by.get(i, row), row)
    score = lambda a, b: sum(x * y for x, y in zip(by[a][1], by[b][1]))
    out = []
    for a in sorted(i for i in by if i % every == 0):
        ranked = sorted((-score(a, i), i) for i in by if i != a)
        for s, p in [x for x in ranked if by[x[1]][0] == by[a][0]][:5]:
            fits = [(t, i) for t, i in ranked if by[i][0] != by[a][0] and 80 * -s <= 100 * -t <= 100 * -s]
            out += [(a, p, r + 1, i, -s, -t) for r, (t, i) in enumerate(fits[:5])]
    return sorted(out)


def vectors(n, dim, scale=1.0, seed=2):
    rnd = random.Random(seed)
    rows = [(i, [round(rnd.gauss(0, 1), 1) * scale for _ in range(dim)], rnd.randint(0, 3)) for i in range(n)]
    common = [0.5 * scale] * dim
    rows += [(n + i, common, i % 4) for i in range(n // 3)]  # one vector holds a quarter of the rows: ties
    rows += [(None, common, 1), (9001, None, 1), (9002, [None, *common[1:]], 1), (9003, [float("nan"), *common[1:]], 2), (9004, [float("inf")] * dim, 0),
             (9005, common, None), (9006, [], 1), (9007, common[:1], 2), rows[5], (10, common, 0), (-20, [-x for x in common], 1)]
    return rows


EMBEDDINGS = "vec_id bigint, embedding array<double>, label int, rank int, score string, row int, slab int"


@pytest.mark.parametrize("scale", [1.0, 1e6], ids=["doubles", "whole-numbers"])
def test_hard_negatives_equal_brute_force(spark, scale, monkeypatch):
    """Over many small tiles and blocks; with scores that only whole numbers hold."""
    for name, value in (("TILE_ROWS", 40), ("LEAF", 4), ("FANOUT", 3), ("BLOCK", 7)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(200, 6, scale)
    table = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], EMBEDDINGS).repartition(3)
    got = hard_negatives.mine(table, every=20)
    want = mined_by_hand(rows, 20)
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.mine(spark.createDataFrame([], EMBEDDINGS)).count() == 0
    alone = spark.createDataFrame([(100, [1.0], 1, 1, "x", 2, 3), (3, None, 1, 1, "x", 2, 3)], EMBEDDINGS)
    assert hard_negatives.mine(alone).count() == 0


def test_boxes_bound_every_inner_product_and_are_pruned():
    import numpy as np

    rnd = np.random.default_rng(0)
    data = np.floor(rnd.normal(0, 100, (500, 3)))
    ids, labels = np.arange(500), np.zeros(500, np.int64)
    order = hard_negatives.str_order(data, labels, ids, 8)
    assert sorted(order) == list(range(500))
    tree = hard_negatives.Tree(ids[order].tobytes(), labels.tobytes(), data[order].astype("<i4").tobytes(), 3, 3, 8, 4)
    anchor = hard_negatives.Anchor(-1, 0, data[0], True, [(-np.inf, np.inf)], 5)
    for level in tree.levels[:1]:
        most, least = anchor.bounds(level, 0, len(level[0]))
        for b, (i, j) in enumerate(zip(level[0], level[1])):
            scores = tree.vectors[i:j] @ data[0]
            assert least[b] <= scores.min() and scores.max() <= most[b]
    visits = []
    anchor.visit = lambda t, i, j: (visits.append(i), hard_negatives.Anchor.visit(anchor, t, i, j))
    anchor.search([tree])
    assert [-s for s, _ in anchor.best[0]] == sorted(data @ data[0], reverse=True)[:5]
    assert len(visits) < len(tree.levels[0][0]) / 2
