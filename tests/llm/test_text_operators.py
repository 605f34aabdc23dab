"""Dedup, sharding, BPE, SimHash and decontamination against brute force on small tables of edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from panel_edit.llm import bpe, decontaminate, exact_dedup, sharding, simhash

SCHEMA = "doc_id bigint, text string, recipe string, fp bigint, hits int, key string"


def word(rnd):
    return "".join(rnd.choice("etaoinshrdluéñ") for _ in range(rnd.randint(1, 9)))


def texts(seed=1, n=40):
    rnd = random.Random(seed)
    base = [" ".join(word(rnd) for _ in range(rnd.randint(1, 400))) for _ in range(n)]
    long = " ".join(word(rnd) for _ in range(9000))
    out = [None, "", " \t\n", "a", *base, base[0], base[0].replace(" ", "  \n"), base[1].upper(), long, long[:40000] + "x" + long[40000:], "x" * 70000]
    return [(i * 3, t) for i, t in enumerate(out)]


def frame(spark, rows, parts=3):
    """Rows with extra columns whose names the operators use inside; the last row twice."""
    rows = [(i, t, "r", 1, 2, "k") for i, t in rows]
    return spark.createDataFrame([*rows, rows[-1]], SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def weak():
    """A digest of three values, as a function that travels by value."""
    return lambda data: bytes([len(data) % 3])


@pytest.mark.parametrize("digest", [exact_dedup.blake, weak()], ids=["sound", "weak"])
def test_exact_dedup_equals_grouping_by_text(spark, digest):
    """Also with a digest under which most chunks clash: identifiers are verified by content."""
    rows = texts()
    groups = {}
    for i, t in [*rows, rows[-1]]:
        groups.setdefault(norm(t), []).append((-len(t or ""), i))
    got = exact_dedup.exact_groups(frame(spark, rows), digest).collect()
    assert len(got) == len(rows) + 1
    by_id = dict(rows)
    for r in got:
        n = norm(by_id[r.doc_id])
        keep = min(groups[n])[1]
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(groups[n]), r.doc_id == keep)
        assert r.text_sha256 == hashlib.sha256(n.encode()).hexdigest()
    assert exact_dedup.exact_groups(empty(spark), digest).count() == 0


def test_dropping_copies_keeps_one_row_and_all_columns(spark):
    rows = texts()
    left = exact_dedup.drop_copies(frame(spark, rows))
    assert left.columns == frame(spark, rows).columns
    assert Counter(norm(r.text) for r in left.collect()) == Counter({norm(t) for _, t in rows})


def test_contents_that_share_a_digest_all_reach_the_dictionary(spark, monkeypatch):
    """A digest that is the same for all chunks, in place of the module's own, too."""
    constant = lambda data: b"same"
    monkeypatch.setattr(exact_dedup, "blake", constant)
    docs = spark.createDataFrame([(1, "aaa"), (2, "bbb"), (3, "a a a"), (4, "ccc")], "doc_id bigint, text string").coalesce(1)
    assert sorted(r.content for r in exact_dedup.chunk_dictionary(docs, constant).collect()) == [b"aaa", b"bbb", b"ccc"]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_groups(docs, constant).collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2), 4: (4, 1)}


HELPERS = ["_id", "_ID", "_raw", "_raw_here", "_row_key", "_Row_Key_", "_score", "_SCORE_", "_hits", "_HITS_", "_stays", "_STAYS_", "fp", "recipe", "k", "copies"]


@pytest.mark.parametrize("name", ["drop_copies", "drop_near_copies", "drop_toxic", "drop_contaminated"])
def test_stages_leave_columns_of_any_name_alone(spark, name):
    """Every helper name as an extra column, in any case; nulls, empties, repeats and empty tables."""
    from panel_edit.llm import toxicity

    rows = [(1, "plain words about rivers and towns in the north " * 3), (2, None), (3, ""), (4, "short"), (1, "plain words about rivers and towns in the north " * 3), (None, "no id here")]
    names = [n for i, n in enumerate(HELPERS) if n.lower() not in {x.lower() for x in HELPERS[:i]}]
    for extra in ([*names], [n.upper() for n in names]):
        df = spark.createDataFrame([(i, t, *(f"{n}{k}" for n in extra)) for k, (i, t) in enumerate(rows)], ", ".join(["doc_id bigint", "text string", *(f"`{n}` string" for n in extra)]))
        labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
        items = spark.createDataFrame([(7, "an item that nothing holds at all in here today")], "item_id bigint, text string")
        stage = {"drop_copies": exact_dedup.drop_copies, "drop_near_copies": simhash.drop_near_copies,
                 "drop_toxic": lambda d: toxicity.drop_toxic(d, labels), "drop_contaminated": lambda d: decontaminate.drop_contaminated(d, items)}[name]
        got = stage(df)
        assert got.columns == df.columns
        out = [tuple(r) for r in got.collect()]
        assert set(out) <= {tuple(r) for r in df.collect()}
        ids = sorted((r[0] is None, r[0] or 0) for r in out)
        if name == "drop_copies":
            assert ids == [(False, 1), (False, 2), (False, 4), (True, 0)]  # null and empty are one text
        elif name != "drop_near_copies":
            assert len(out) == len(rows)
        assert stage(df.limit(0)).count() == 0


def test_passages_of_unspaced_scripts_are_found_inside_longer_runs():
    zh = "江河流過北方的城鎮每年春天人們在岸邊種下新的樹木並記錄水位的變化以便日後比較"
    th = "แม่น้ำไหลผ่านเมืองทางเหนือทุกฤดูใบไม้ผลิผู้คนปลูกต้นไม้ใหม่"
    for item in (zh, th):
        index = decontaminate.ItemIndex([(5, item)], decontaminate.STRIDE)
        for text, want in (("前" * 40 + "說" + item + "完了" * 30, True), (f"see {item}", True), ("完了前說" * 60, False), (item[: len(item) // 2] + "完" * 40, False)):
            raw = np.frombuffer(text.encode(), np.uint8)
            assert bool(decontaminate.search(index, raw, np.array([0, len(raw)]), decontaminate.MAX_EDIT)) == want


def test_chunks_are_cut_alike_wherever_a_passage_stands():
    rnd = np.random.default_rng(0)
    passage, head = rnd.integers(97, 122, 60000, dtype=np.uint8), rnd.integers(97, 122, 777, dtype=np.uint8)
    def chunks(data):
        ends = exact_dedup.chunk_bounds(exact_dedup.cut_points(data), len(data))
        assert ends[-1] == len(data) and max(np.diff([0, *ends])) <= exact_dedup.MAX_CHUNK
        return set(exact_dedup._pieces(data.tobytes(), ends))
    a, b = chunks(passage), chunks(np.concatenate([head, passage]))
    assert len(a & b) >= 0.8 * len(a)


def test_sharding_balances_and_keeps_groups_together(spark):
    rows = texts(n=400)
    got = sharding.shard_by_size(frame(spark, rows), 16).collect()
    by_id = dict(rows)
    shard_of, load, slots = {}, Counter(), {}
    for r in got:
        t = by_id[r.doc_id] or ""
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t.encode()) + 1, zlib.crc32(t.encode()), "bytes", None)
        assert shard_of.setdefault(t, r.shard) == r.shard
        load[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(load) == set(range(16))
    sizes = Counter()
    for r in got:
        sizes[by_id[r.doc_id] or ""] += r.size
    mean = sum(load.values()) / 16
    full = {shard_of[t] for t, size in sizes.items() if size > mean}  # a group that can't be split fills its shard
    rest = [load[s] for s in range(16) if s not in full]
    assert len(rest) >= 8 and max(rest) - min(rest) <= 0.01 * max(rest)
    assert sharding.shard_by_size(empty(spark)).count() == 0


def test_lpt_takes_the_largest_first():
    placed = sharding.lpt([(7, "a"), (6, "b"), (5, "c"), (4, "d"), (4, "e"), (2, "f")], 2)
    loads = Counter()
    for s, u in [(7, "a"), (6, "b"), (5, "c"), (4, "d"), (4, "e"), (2, "f")]:
        loads[placed[u]] += s
    assert sorted(loads.values()) == [13, 15]


def test_slots_are_gapless_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 3)
    got = sharding.shard_by_size(frame(spark, texts(n=300)), 4).collect()
    for s in range(4):
        own = [r.slot for r in got if r.shard == s]
        assert sorted(own) == list(range(len(own)))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path())


def test_bpe_equals_the_library(library):
    codec, rnd = bpe.Codec(bpe.vocabulary_path()), random.Random(5)
    alphabet = "abcdefgeeethnABC  \n\t0123'''.,!?-éßñçÈœ日本語😀\u0301İΣ\x1c\x85\xa0\u3000²½"
    cases = ["", "foo<|endoftext|>bar <|startoftext|>" + "x" * 900 + "<|endoftext|>y", "a" * 20000, "<|", "ΑΣ ΑΣ"]
    cases += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(600)]
    for _ in range(20):
        letters = rnd.choice(["ab", "eothin", "é日ab", "'restvlldm", "12a!'s"])
        cases.append("".join(rnd.choice(letters) for _ in range(rnd.randint(600, 5000))))
    for t in cases:
        want = library.encode(t, add_special_tokens=False).ids
        assert codec.encode(t) == want, t[:60]
        assert codec.decode(want) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("part", [1000, bpe.PART_CHARS])
def test_token_digests_of_whole_texts(spark, library, monkeypatch, part):
    monkeypatch.setattr(bpe, "PART_CHARS", part)
    rows = texts()
    got = bpe.token_digests(frame(spark, rows), part_chars=part).collect()
    assert sorted(r.doc_id for r in got) == sorted([i for i, _ in rows] + [rows[-1][0]])
    by_id = dict(rows)
    for r in got:
        ids = library.encode(by_id[r.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    assert bpe.token_digests(empty(spark)).count() == 0


UNSPLIT = ["x" * 400_000, "ab'sé日<|endoftext|>" * 9000, "'restvlldm12a!" * 12000, "e\u0301\u0327a\u1100\u1161\u11a8" * 9000, "\u0301" * 40000]


def test_unsplit_text_is_encoded_in_parts_and_joined_as_a_tree(spark, library):
    """Runs without white space: every part is encoded apart from the others, and the joined ids are the library's."""
    codec = bpe.Codec(bpe.vocabulary_path())
    rnd = random.Random(9)
    cases = [*UNSPLIT, "".join(rnd.choice("eothin'sé1!") for _ in range(400_000))]
    for t in cases[1:3] + cases[-1:]:
        parts = bpe.cut_text(t, 16384, codec.special)
        assert "".join(p for _, p in parts) == t and {r for r, _ in parts} == {0} and all(len(p) <= 16384 for _, p in parts) and len(parts) > 8
    rows = [(i, t) for i, t in enumerate(cases)] + [(50, "word " * 9000 + cases[-1][:90_000] + "\u3000" + "é" * 60_000 + " end"), (51, " " * 50_000), (52, "a" * 32_768 + " b")]
    got = bpe.token_digests(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == sorted([i for i, _ in rows] + [rows[-1][0]])
    by_id = dict(rows)
    for r in got:
        ids = library.encode(by_id[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()), r.doc_id


def test_no_task_encodes_an_unsplit_run_whole(monkeypatch):
    """The calls that encode: one per part, of a part's length; joins encode windows only."""
    codec = bpe.Codec(bpe.vocabulary_path())
    rnd = random.Random(4)
    for letters in ("eothin", "eothin'sé1!"):
        text = "".join(rnd.choice(letters) for _ in range(400_000))
        parts = [p for _, p in bpe.cut_text(text, 32_768, codec.special)]
        units = [codec.run_units(p) for p in parts]
        assert len(units) == 13
        calls = []
        tree = codec._tree
        monkeypatch.setattr(codec, "_tree", lambda symbols: (calls.append(len(symbols)), tree(symbols))[1])
        while len(units) > 1:
            units = [codec.join_units(units[i], units[i + 1]) if i + 1 < len(units) else units[i] for i in range(0, len(units), 2)]
        monkeypatch.undo()
        assert "".join(units[0][0]) == text and max(calls, default=0) < 2000 and len(calls) < 200
        assert [codec.id_of[t] for own in units[0][1] for t in own] == codec.library.encode(text, add_special_tokens=False).ids


def test_cuts_keep_whole_what_goes_over_them():
    codec = bpe.Codec(bpe.vocabulary_path())
    for t in ("ab<|endoftext|>" * 50, "e\u0301\u0327" * 300, "\u1100\u1161\u11a8" * 300, "\u0301" * 900, "a b" * 400, "a" * 300 + " " + "b" * 300):
        for size in (16, 17, 31, 100):
            parts = bpe.cut_text(t, size, codec.special)
            assert "".join(p for _, p in parts) == t
            for (run, left), (_, right) in zip(parts, parts[1:]):
                if run >= 0 and not bpe._FIRST_SPACE.match(right):
                    assert codec._normalised(left + right) == codec._normalised(left) + codec._normalised(right)


def fingerprint(t, size=3):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
    shingles = [" ".join(w[k:k + size]) for k in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    """Smallest id reachable, by brute force over ``{id: fingerprint}``."""
    root = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            for j in fps:
                if (fps[i] ^ fps[j]).bit_count() <= 2 and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


@pytest.mark.parametrize("capacity", [None, 4])
def test_simhash_groups_equal_brute_force(spark, capacity):
    rows = texts(7, 30)
    rnd = random.Random(2)
    near = [(1000 + k, t + " " + word(rnd)) for k, (_, t) in enumerate(rows) if t and len(t) > 1500]
    rows += near
    fps = {i: fingerprint(t) for i, t in rows}
    want = components(fps)
    got = simhash.near_groups(frame(spark, rows), capacity=capacity).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        assert r.fp & (1 << 64) - 1 == fps[r.doc_id]
        assert r.component_id == want[r.doc_id]
    assert simhash.near_groups(empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    """Fingerprints that are linked only one after the other, and a dense cluster."""
    chain, v = [], 0
    for k in range(20):
        v ^= 0b11 << (2 * k)
        chain.append(v)
    cluster = [(1 << 63) ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]
    fps = {i: f for i, f in enumerate([*chain, *cluster])}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps.values()]
    distinct = spark.createDataFrame(signed, "fp bigint")
    edges = simhash.links(distinct, 2, capacity=8)
    roots = {r.member & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in simhash.components(edges).collect()}
    brute = components(fps)
    assert len({roots.get(f, f) for f in fps.values()}) == len(set(brute.values()))
    for i in fps:
        for j in fps:
            assert (roots.get(fps[i], fps[i]) == roots.get(fps[j], fps[j])) == (brute[i] == brute[j])


def test_near_copies_leave_the_smallest(spark):
    rows = texts(9, 10)
    want = components({i: fingerprint(t) for i, t in rows})
    left = simhash.drop_near_copies(frame(spark, rows))
    assert left.columns == frame(spark, rows).columns
    assert {r.doc_id for r in left.collect()} == set(want.values())


def edit_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_best_match_equals_dynamic_programming():
    rnd = random.Random(3)
    for _ in range(200):
        p, t = ("".join(rnd.choice("abc") for _ in range(rnd.randint(a, b))) for a, b in ((1, 12), (0, 30)))
        distance = edit_distance(p, t)
        assert decontaminate.best_match(p, t) == distance
        assert all(decontaminate.may_match(p, t, k) for k in range(distance, 13))


def items(n=60, seed=11):
    rnd = random.Random(seed)
    return [(i, " ".join(word(rnd) for _ in range(rnd.randint(15, 60)))) for i in range(n)]


def spoilt(text, rate, rnd):
    out = []
    for w in text.split():
        x = rnd.random()
        out += [] if x < rate / 3 else [word(rnd)] if x < 2 * rate / 3 else [w, word(rnd)] if x < rate else [w]
    return " ".join(out)


def test_decontamination_finds_passages_and_spares_clean_texts(spark):
    rnd, bench = random.Random(4), items()
    filler = lambda: " ".join(word(rnd) for _ in range(rnd.randint(0, 90)))
    verbatim = [(i, f"{filler()} {t.upper().replace(' ', ', ')} {filler()}") for i, t in bench]
    clean = [(1000 + k, filler()) for k in range(60)] + [(2000, None), (2001, ""), (2002, " ".join(filler() for _ in range(300)))]
    table = spark.createDataFrame([*bench, bench[0], (900, None), (901, " . "), (902, "zyx qpv")], "item_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(frame(spark, [*verbatim, *clean, (3000, "a zyx, qpv b")]), table).collect()}
    assert all(got[i].item_ids == [i] and got[i].distances == [0] for i, _ in verbatim)
    assert not any(got[i].contaminated for i, _ in clean) and got[3000].item_ids == [902]
    assert decontaminate.contamination(empty(spark), table).count() == 0
    nothing = table.where("item_id < 0")
    assert decontaminate.contamination(frame(spark, clean), nothing).where("contaminated").count() == 0
    left = decontaminate.drop_contaminated(frame(spark, [*verbatim, *clean]), table)
    assert {r.doc_id for r in left.collect()} == {i for i, _ in clean} and left.columns == frame(spark, clean).columns


@pytest.mark.parametrize("rate,floor", [(0.03, 0.98), (0.08, 0.97), (0.12, 0.96), (0.15, decontaminate.TARGET_RECALL)])
def test_decontamination_recall_on_edited_passages(rate, floor):
    import pyarrow as pa

    from panel_edit.llm.common import text_buffer

    rnd, bench = random.Random(6), items(300)
    index = decontaminate.ItemIndex(bench, decontaminate.STRIDE)
    docs = [f"{' '.join(word(rnd) for _ in range(rnd.randint(3, 50)))} {spoilt(t, rate, rnd)} {word(rnd)}" for _, t in bench]
    within = [decontaminate.best_match(t, d) <= int(0.2 * len(t)) for (_, t), d in zip(bench, docs)]
    found = decontaminate.search(index, *text_buffer(pa.array(docs), lower=True), decontaminate.MAX_EDIT)
    hits = sum(1 for k, (i, _) in enumerate(bench) if within[k] and i in found.get(k, {}))
    assert sum(within) >= 100 and hits >= floor * sum(within)


def edited_recall(bench, rate, seed):
    """Share found of the edited copies of ``bench`` that are within MAX_EDIT."""
    import pyarrow as pa

    from panel_edit.llm.common import text_buffer

    rnd = random.Random(seed)
    stride = decontaminate.STRIDE if min(len(t.split()) for _, t in bench) >= decontaminate.SHORT else 1
    docs = [f"{' '.join(word(rnd) for _ in range(rnd.randint(3, 50)))} {spoilt(t, rate, rnd)} {word(rnd)}" for _, t in bench]
    within = [decontaminate.best_match(t, d) <= int(0.2 * len(t)) for (_, t), d in zip(bench, docs)]
    found = decontaminate.search(decontaminate.ItemIndex(bench, stride), *text_buffer(pa.array(docs), lower=True), decontaminate.MAX_EDIT)
    return sum(1 for k, (i, _) in enumerate(bench) if within[k] and i in found.get(k, {})) / max(sum(within), 1)


@pytest.mark.parametrize("seed", [1, 2, 6])
def test_decontamination_target_holds_on_each_seed(seed):
    assert edited_recall(items(400, seed + 5), 0.15, seed) >= 0.95


@pytest.mark.parametrize("n,trials", [(4, 300), (5, 300), (6, 300), (7, 300), (8, 300), (10, 300), (13, 300), (17, 300), (23, 300), (31, 300), (42, 200),
                                      (58, 200), (80, 150), (111, 100), (154, 80), (214, 60), (298, 60), (300, 60), (400, 40), (700, 25), (1000, 20)])
def test_decontamination_target_holds_at_each_length(n, trials):
    rnd = random.Random(n)
    assert edited_recall([(i, " ".join(word(rnd) for _ in range(n))) for i in range(trials)], 0.15, 6) >= 0.95


def test_long_item_with_its_edits_in_one_place_is_found():
    """All of the first or last eighth of the words replaced: the other places are whole."""
    rnd, n = random.Random(8), 320
    item = [word(rnd) for _ in range(n)]
    index = decontaminate.ItemIndex([(7, " ".join(item))], decontaminate.STRIDE)
    for a in (0, n - n // 8):
        copy = [word(rnd) if a <= k < a + n // 8 else w for k, w in enumerate(item)]
        data = np.frombuffer(f"x yz {' '.join(copy)} z".encode(), np.uint8)
        assert list(decontaminate.search(index, data, np.array([0, len(data)]), decontaminate.MAX_EDIT)[0]) == [7]


def test_items_in_blocks_give_the_same_result(spark, monkeypatch):
    bench = items(30)
    docs = frame(spark, [(i, "start " + t + " end") for i, t in bench])
    table = spark.createDataFrame(bench, "item_id bigint, text string")
    one = sorted(map(str, decontaminate.contamination(docs, table).collect()))
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 7)
    assert sorted(map(str, decontaminate.contamination(docs, table).collect())) == one
