"""BPE encoding and decoding of whole texts, long unsplit text by tree concatenation.

Text falls apart at white space, which the vocabulary drops, so the distinct
pieces between white space of a block of texts are encoded once, their distinct
words once, and token arrays of the texts are gathered from those.

A long text is cut into parts that different tasks encode: after white space
where there is some, else inside a run without any. The parts of such a run are
then joined as a tree, two neighbours at a time, each pair in a task of its own:
a window around the join is encoded anew, and grows until it ends on both sides
with what the halves had there - first windows of words, and where one word goes
over the cut, windows of its tokens. A sequence of tokens is the encoding of its
text exactly if each neighbouring pair is the encoding of the pair's text, and
every pair then stems from a finished encoding, so the result is exact. Cuts
keep away from special tokens and from characters that compose over them.

The same tree is used within a task, for runs and words of over ``LEAF_RUN`` code
points and ``LEAF_WORD`` bytes.

Defined cases: null text counts as empty; an empty text has no tokens; strings
of special tokens in a text become those tokens, as in the library; a repeated
row gives a repeated result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from itertools import chain
from unicodedata import combining, is_normalized, normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panel_edit.llm.common import keep, ship

#: Code points of a part of a long text; a text of more is encoded in several tasks.
PART_CHARS = 32768
#: Code points of a run without white space, and bytes of a word, that are encoded at once.
LEAF_RUN, LEAF_WORD = 512, 64
#: Code points of the texts that are encoded together (a longer text is encoded alone).
BLOCK_CHARS = 3 << 19

#: White space of the library's normaliser, as a character class (``\\s`` of its pattern language).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Python also splits at these, which the vocabulary keeps as text.
_NOT_SPACE = regex.compile("[\x1c-\x1f]")
_RUN = regex.compile(f"[^{SPACE}]+")
_FIRST_SPACE, _LAST_SPACE = regex.compile(f"[{SPACE}]"), regex.compile(f"(?r)[{SPACE}]")

OUT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def vocabulary_path() -> str:
    """Default vocabulary file (the contract's ``word_bpe_49k.json``)."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_symbols() -> dict[int, str]:
    """The printable character that a byte-level vocabulary writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(other)}}


def join_windows(left: list, right: list, again: Callable[[list, list], list], start: int = 2) -> list:
    """Join the encodings of two halves.

    ``again(l, r)`` encodes the text of the units ``l`` and ``r`` anew. The
    window of ``k`` units on each side doubles until its first unit is the
    half's own (or the window has reached the half's end), and likewise its last.
    """
    k = start
    while True:
        l, r = left[-k:], right[:k]
        new = again(l, r)
        left_agrees = len(l) == len(left) or (len(l) > 1 and new[:1] == l[:1])
        right_agrees = len(r) == len(right) or (len(r) > 1 and new[-1:] == r[-1:])
        if left_agrees and right_agrees:
            return left[:len(left) - len(l)] + new + right[len(r):]
        k *= 2


class Codec:
    """The vocabulary of one file: encodes and decodes exactly as the library does."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.end = model.get("end_of_word_suffix") or ""
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"].replace("\\s", SPACE))
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.names = {**{i: t for t, i in self.ids.items()}, **{t["id"]: t["content"] for t in spec["added_tokens"]}}
        self.special_ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.symbols = _byte_symbols()
        size = max(self.names) + 1
        self.numbers = pa.array([str(i) for i in range(size)])
        self.contents = pa.array([self.names.get(i) for i in range(size)])
        self.id_of = {t: i for i, t in self.names.items()}
        self.byte_table = {b: c for b, c in self.symbols.items()}

    # Words: byte symbols merged by rank, the end of the word marked.

    def _merge(self, symbols: list[str]) -> list[str]:
        symbols = list(symbols)
        while len(symbols) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            out, i, n = [], 0, len(symbols)
            while i < n:
                if i < n - 1 and ranks[i] == best and (symbols[i], symbols[i + 1]) in self.rank:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def _split_symbols(self, tokens: list[str]) -> list[str]:
        out: list[str] = []
        for t in tokens:
            if self.end and t.endswith(self.end) and len(t) > len(self.end):
                chars = list(t[: -len(self.end)])
                chars[-1] += self.end
                out += chars
            else:
                out += list(t)
        return out

    def word_tokens(self, word: str) -> list[str]:
        """Token strings of one pre-split word (already normalised)."""
        symbols = [self.symbols[b] for b in word.encode()]
        symbols[-1] += self.end
        return self._tree(symbols)

    def _tree(self, symbols: list[str]) -> list[str]:
        if len(symbols) <= LEAF_WORD:
            return self._merge(symbols)
        level = [self._merge(symbols[i:i + LEAF_WORD]) for i in range(0, len(symbols), LEAF_WORD)]
        while len(level) > 1:  # neighbours join, as halves of the next larger part
            level = [join_windows(level[i], level[i + 1], lambda a, b: self._merge(self._split_symbols(a + b)))
                     if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0]

    # Runs without white space: words as units.

    def _normalised(self, run: str) -> str:
        return self.library.normalizer.normalize_str(run)

    def _units(self, text: str) -> list[str]:
        return self.words.findall(text)

    def _words_of(self, text: str) -> list[str]:
        """Words of a normalised run: those of its leaves, joined as a tree. A word that
        begins at a cut may belong to the word before it, so the window of words is
        split anew until both sides agree."""
        level = [self._units(text[i:i + LEAF_RUN]) for i in range(0, len(text), LEAF_RUN)] or [[]]
        while len(level) > 1:
            level = [join_windows(level[i], level[i + 1], lambda a, b: self._units("".join(a + b)))
                     if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0]

    def run_units(self, run: str) -> tuple[list[str], list[list[str]]]:
        """The words of a run without white space and the tokens of each; a special token is an empty word."""
        words: list[str] = []
        tokens: list[list[str]] = []

        def plain(text: str) -> None:
            found = self._words_of(self._normalised(text))
            words.extend(found)
            tokens.extend(map(self.word_tokens, found))

        at = 0
        for m in self.special.finditer(run) if self.special else ():
            plain(run[at:m.start()])
            words.append("")
            tokens.append([m[0]])
            at = m.end()
        plain(run[at:])
        return words, tokens

    def join_units(self, left: tuple[list, list], right: tuple[list, list]) -> tuple[list, list]:
        """The words and tokens of two neighbouring parts of one run, joined."""
        (lw, lt), (rw, rt) = left, right
        i = max((k + 1 for k, w in enumerate(lw) if not w), default=0)
        j = next((k for k, w in enumerate(rw) if not w), len(rw))
        a, b = lw[i:], rw[:j]
        if not a or not b:  # nothing merges with a special token
            return lw + rw, lt + rt
        joined = join_windows(a, b, lambda x, y: self._units("".join(x + y)))
        p = 0
        while p < min(len(a), len(joined)) and joined[p] == a[p]:
            p += 1
        q = 0
        while q < min(len(b), len(joined) - p) and joined[-1 - q] == b[-1 - q]:
            q += 1
        middle = joined[p:len(joined) - q]
        if middle == [a[-1] + b[0]] and p == len(a) - 1 and q == len(b) - 1:  # one word goes over the cut
            made = [join_windows(lt[-1], rt[0], self._window)]
        else:
            made = list(map(self.word_tokens, middle))
        return lw[:i] + joined + rw[j:], lt[:i + p] + made + rt[j - q:]

    def _window(self, left: list[str], right: list[str]) -> list[str]:
        """Tokens of the last tokens of one half of a word and the first of the other."""
        symbols = self._split_symbols(left)
        if self.end:
            symbols[-1] = symbols[-1].removesuffix(self.end)  # the word does not end at the cut
        return self._tree(symbols + self._split_symbols(right))

    def run_ids(self, run: str) -> list[int]:
        """Ids of a long run without white space."""
        return [self.id_of[t] for own in self.run_units(run)[1] for t in own]

    # Whole texts.

    def runs(self, text: str) -> list[str]:
        """The pieces between white space."""
        return text.split() if not _NOT_SPACE.search(text) else _RUN.findall(text)

    def _word_ids(self, word: str) -> list[int]:
        plain = word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(self.byte_table)
        return [t.id for t in self.library.model.tokenize(plain)]

    def _as_one(self, run: str) -> bool:
        """Whether a piece is more than words: long, with a special token, or with characters that the normaliser changes."""
        return len(run) > LEAF_RUN or "<|" in run or "\u03a3" in run or not is_normalized("NFC", run)

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text among them)."""
        split = list(map(self.runs, texts))
        flat_runs = list(chain.from_iterable(split))
        place = {r: k for k, r in enumerate(dict.fromkeys(flat_runs))}
        of_text = np.fromiter(map(place.__getitem__, flat_runs), np.int64, len(flat_runs))
        found, findall = [], self.words.findall
        whole: dict[str, list[int]] = {}  # pieces that are encoded in one, under names that no word has
        for run in place:
            if run.isascii() and len(run) <= LEAF_RUN and "<|" not in run or not self._as_one(run):
                found.append(findall(run.lower()))  # lower case is all there is to normalise
            else:
                found.append([f" {run}"])
                whole[f" {run}"] = self.run_ids(run) if len(run) > LEAF_RUN else self.library.encode(run, add_special_tokens=False).ids
        per_piece = np.fromiter(map(len, found), np.int64, len(found))
        flat_words = list(chain.from_iterable(found))
        words = {w: k for k, w in enumerate(dict.fromkeys(flat_words))}
        unit = np.fromiter(map(words.__getitem__, flat_words), np.int64, len(flat_words))
        ids = [whole[w] if w in whole else self._word_ids(w) for w in words] if whole else list(map(self._word_ids, words))
        per_word = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(per_word.sum()))
        units, per_run = _gather(unit, per_piece, of_text)
        tokens, per_unit = _gather(flat, per_word, units)
        unit_ends = np.concatenate([[0], np.cumsum(per_run)])[np.cumsum([0, *map(len, split)])]
        return tokens, np.concatenate([[0], np.cumsum(per_unit)])[unit_ends][1:]

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        return self.encode_many([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of ids, special tokens included (the file names no decoder: tokens are joined by spaces)."""
        return " ".join([self.names[i] for i in ids if i in self.names])

    def digests(self, ids: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[str], list[str]]:
        """(number, digest of the ids, digest of the decoded text) of each text."""
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        out = []
        for table in (self.numbers, self.contents):
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, table.take(pa.array(ids))), " ")
            out.append([hashlib.sha256(x.as_buffer()).hexdigest() for x in joined])
        return np.diff(ends, prepend=0).tolist(), *out


def _gather(values: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``chosen`` (of ``sizes`` consecutive values each), one after the other, and their sizes."""
    first = np.cumsum(sizes) - sizes
    size = sizes[chosen]
    shift = np.repeat(first[chosen] - (np.cumsum(size) - size), size)
    return values[shift + np.arange(len(shift))], size


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per Python worker and file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _text_blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of up to ``BLOCK_CHARS`` code points, or of one text."""
    i = size = 0
    for j, t in enumerate(texts):
        if j > i and size + len(t) > BLOCK_CHARS:
            yield i, j
            i, size = j, 0
        size += len(t)
    if i < len(texts):
        yield i, len(texts)


def _encode_rows(path: str):
    def run(batches):
        c = codec(path)
        for batch in batches:
            doc_id, text = batch.column("doc_id"), batch.column("text").to_pylist()
            for i, j in _text_blocks(text):
                n, ids, decoded = c.digests(*c.encode_many(text[i:j]))
                yield pa.RecordBatch.from_arrays([doc_id.slice(i, j - i), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def safe_cut(text: str, at: int, special) -> bool:
    """Whether nothing goes over the cut at ``at`` but words: no special token, no characters that compose."""
    if combining(text[at]):
        return False
    left, right = text[max(0, at - 16):at], text[at:at + 16]
    if normalize("NFC", left + right) != normalize("NFC", left) + normalize("NFC", right):
        return False
    low = max(0, at - 64)
    return not special or all(not m.start() < at - low < m.end() for m in special.finditer(text[low:at + 64]))


def cut_text(text: str, size: int, special=None) -> list[tuple[int, str]]:
    """Parts of a text of about ``size`` code points: (-1, part) that ends at white space or with the text,
    and (number of the first one, part) for the parts of a run that has no white space for so long."""
    out: list[tuple[int, str]] = []
    a, n, run = 0, len(text), -1
    while a < n:
        b = min(a + size, n)
        if run >= 0:
            end = _FIRST_SPACE.search(text, a, b)
            if end:
                out += [(run, text[a:end.start()])] * (end.start() > a)
                a, run = end.start(), -1
                continue
        elif b < n:
            end = _LAST_SPACE.search(text, a, b)
            if end:
                out.append((-1, text[a:end.end()]))
                a = end.end()
                continue
            run = len(out)
        if b < n:
            c = b
            while c > a + 1 and not safe_cut(text, c, special):
                c -= 1
            if c == a + 1:  # none before it: the next one behind
                c = b
                while c < n and not safe_cut(text, c, special) and not _FIRST_SPACE.match(text, c):
                    c += 1
            b = c
        out.append((run, text[a:b]))
        a = b
    return out


CUT = "doc_id bigint, text_key binary, seq int, run int, part string"
PART = "doc_id bigint, text_key binary, seq int, run int, copies bigint, ids array<int>, words array<string>, tokens array<array<string>>"
_STRINGS, _LISTS = pa.list_(pa.string()), pa.list_(pa.list_(pa.string()))


def _cut_rows(path: str, size: int):
    """Long texts as rows of parts."""

    def run(batches):
        special = codec(path).special
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                key, parts = hashlib.sha256(text.encode()).digest(), cut_text(text, size, special)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id] * len(parts), pa.int64()), pa.array([key] * len(parts), pa.binary()), pa.array(range(len(parts)), pa.int32()),
                     pa.array([r for r, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.string())],
                    ["doc_id", "text_key", "seq", "run", "part"])

    return run


def _encode_parts(path: str):
    """Ids of the parts that end at white space; words and tokens of the parts of unsplit runs."""

    def run(batches):
        c = codec(path)
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.column("part")[k].as_py()
                split = batch.column("run")[k].as_py() < 0
                words, tokens = ([], []) if split else c.run_units(part)
                ids = c.encode_many([part])[0].tolist() if split else []
                yield pa.RecordBatch.from_arrays(
                    [batch.column(name).slice(k, 1) for name in ("doc_id", "text_key", "seq", "run", "copies")]
                    + [pa.array([ids], pa.list_(pa.int32())), pa.array([words], _STRINGS), pa.array([tokens], _LISTS)],
                    ["doc_id", "text_key", "seq", "run", "copies", "ids", "words", "tokens"])

    return run


def _join_pair(path: str):
    """Two neighbours of one run (or the last one, alone) as one."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
        units = [(r["words"], r["tokens"]) for r in rows]
        words, tokens = codec(path).join_units(*units) if len(units) == 2 else units[0]
        first = rows[0]
        return pa.table({"doc_id": pa.array([first["doc_id"]], pa.int64()), "text_key": pa.array([first["text_key"]], pa.binary()),
                         "seq": pa.array([first["seq"]], pa.int32()), "run": pa.array([first["run"]], pa.int32()),
                         "copies": pa.array([first["copies"]], pa.int64()), "ids": pa.array([[]], pa.list_(pa.int32())),
                         "words": pa.array([words], _STRINGS), "tokens": pa.array([tokens], _LISTS), "k": pa.array([first["k"]], pa.int32())})

    return run


def _whole_text(path: str):
    """The digests of one text, from its parts in order."""

    def run(table: pa.Table) -> pa.Table:
        c = codec(path)
        rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
        ids = [i for r in rows for i in (r["ids"] or [c.id_of[t] for own in r["tokens"] for t in own])]
        n, digest, decoded = c.digests(np.array(ids, np.int32), np.array([len(ids)]))
        copies = rows[0]["copies"]
        return pa.table({"doc_id": pa.array([rows[0]["doc_id"]] * copies, pa.int64()), "n_tokens": pa.array(n * copies, pa.int64()),
                         "ids_sha256": pa.array(digest * copies, pa.string()), "decoded_sha256": pa.array(decoded * copies, pa.string())})

    return run


def joined_runs(runs: DataFrame, path: str) -> DataFrame:
    """The parts of each unsplit run, joined two by two in as many rounds as the longest run needs."""
    most = runs.agg(F.max(F.col("seq") - F.col("run"))).first()[0] or 0
    level = runs.withColumn("k", F.col("seq") - F.col("run"))
    for _ in range(most.bit_length()):
        level = level.withColumn("k", F.shiftright("k", 1)).groupBy("doc_id", "text_key", "run", "k").applyInArrow(_join_pair(path), f"{PART}, k int")
    return level.drop("k")


def token_digests(docs: DataFrame, path: str | None = None, part_chars: int = PART_CHARS) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A text of up to ``part_chars`` code points is encoded in one go; the parts
    of a longer one are dealt to different tasks, and only they are shuffled.
    """
    ship(docs.sparkSession)
    path = path or vocabulary_path()
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    short = slim.where(F.length("text") <= part_chars).mapInArrow(_encode_rows(path), OUT)
    cut = slim.where(F.length("text") > part_chars).mapInArrow(_cut_rows(path, part_chars), CUT)
    # One row for the same part of repeated rows; a task of its own may encode each part.
    parts = cut.groupBy("doc_id", "text_key", "seq", "run").agg(F.any_value("part").alias("part"), F.count(F.lit(1)).alias("copies"))
    encoded = keep(parts.mapInArrow(_encode_parts(path), PART))
    runs = joined_runs(encoded.where("run >= 0"), path)
    long = encoded.where("run < 0").unionByName(runs).groupBy("doc_id", "text_key").applyInArrow(_whole_text(path), OUT)
    return short.unionByName(long)
