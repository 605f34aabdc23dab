"""Shared helpers: reading tables, lineage cuts, code shipping, Arrow text buffers and word hashes."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Code points that the contracts count as white space: ``[\x20\x09-\x0D]``.
ASCII_SPACE = " \t\n\x0b\x0c\r"

#: Bytes of text that one numpy step works on (a longer text is a step of its own).
BLOCK_BYTES = 1 << 20

_SHIPPED: set[str] = set()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application (they need no installation)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="panel-edit-"), "panel_edit_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names (on storage all executors share).

    Only where none is named, on one machine as in tests, a private one is set.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="panel-edit-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, so that nothing recomputes it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, in the shared folder."""
    return f"{shared_folder(spark)}/training_data_scratch/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was written under a path of :func:`scratch`."""
    if "/training_data_scratch/" not in path:
        raise ValueError(f"not a scratch path: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of frames that nothing refers to any more: Spark deletes them once the driver's garbage is collected."""
    gc.collect()
    spark._jvm.System.gc()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_buffer(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if lower:
        column = pc.utf8_lower(column)
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    raw = column.buffers()[2] if n else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``size`` bytes, or one row where that is longer."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


#: Odd multiplier of the word hash and one random value per byte (from a fixed seed).
_MUL = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
#: Word bytes: ASCII letters and digits, and every byte of a non-ASCII character.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 4096)
        inverse = pow(_MUL, -1, 1 << 64)
        tables = {}
        for key, m in (("up", _MUL), ("down", inverse)):
            t = np.full(size, m, np.uint64)
            t[0] = 1
            tables[key] = np.multiply.accumulate(t)
        if size > 8 * BLOCK_BYTES:  # one huge text: don't hold its tables
            return tables["up"], tables["down"]
        _powers.update(tables)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser: spreads 64-bit values (uint64 in, uint64 out)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each character of Chinese, Japanese, Thai, Lao, Khmer and Burmese script (three bytes each)."""
    lead, second = data[:-2], data[1:-1]
    at = np.flatnonzero((lead >= 0xE3) & (lead <= 0xE9) | (lead == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
                        | (lead == 0xE1) & ((second >= 0x80) & (second <= 0x82) | (second >= 0x9E) & (second <= 0x9F)))
    return at, at + 3


def words(data: np.ndarray, offsets: np.ndarray, stems: tuple[int, ...] = ()):
    """Words of consecutive texts: (hash, first byte, end byte, row) per word.

    A word is a maximal run of word bytes within one text, or one character of a
    script that is written without spaces; its hash depends on its bytes alone. With ``stems``, (hash, row) of each word and of the
    first k bytes of each longer word, for each k of ``stems``, by text.
    """
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return (np.zeros(0, np.uint64), z) if stems else (np.zeros(0, np.uint64), z, z, z)
    is_word = np.empty(n + 2, bool)
    is_word[0] = is_word[-1] = False
    np.take(WORD_BYTE, data, out=is_word[1:-1])
    if data.max() >= 0xE3:  # ideographic space and punctuation, U+3000 to U+303F
        at = np.flatnonzero((data[:-2] == 0xE3) & (data[1:-1] == 0x80))
        for k in (1, 2, 3):
            is_word[at + k] = False
    edge = np.flatnonzero(is_word[1:] != is_word[:-1])
    start, end = edge[0::2], edge[1::2]
    # A run that crosses from one text into the next is two words, and each
    # character of a script without spaces is a word of its own.
    inner = offsets[1:-1]
    if data.max() >= 0xE0:
        inner = np.concatenate([inner, *unspaced(data)])
    inner = np.unique(inner[(inner > 0) & (inner < n)])
    cross = inner[is_word[inner] & is_word[inner + 1]]
    if len(cross):
        start = np.sort(np.concatenate([start, cross]))
        end = np.sort(np.concatenate([end, cross]))
    up, down = _power_tables(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    h = (sums[end] - sums[start]) * down[start]
    row = np.searchsorted(offsets, start, "right") - 1
    if not stems:
        return mix(h), start, end, row
    hashes, rows = [mix(h)], [row]
    for k in stems:
        longer = np.flatnonzero(end - start > k)
        first = start[longer]
        hashes.append(mix((sums[first + k] - sums[first]) * down[first] + np.uint64(k)))
        rows.append(row[longer])
    return np.concatenate(hashes), np.concatenate(rows)


def word_hash(word: str) -> int:
    """The hash that :func:`words` gives to one (lower-cased) word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    h = words(raw, np.array([0, len(raw)]))[0]
    if len(h) != 1:
        raise ValueError(f"not a single word: {word!r}")
    return int(h[0])
