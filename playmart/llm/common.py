"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.session import scratch_dir


def importable(spark: SparkSession) -> None:
    """Let Python workers that share this machine's file system import the package from where it lies.

    On a cluster without that, ship it with --py-files.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m.  A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(m))


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet beneath the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of a text with A-Z lower-cased, in UTF-8.

    On bytes, lower() changes A-Z alone and split() cuts at exactly those six characters.
    """
    return text.encode().lower().split() if text else []


class WordHashes(dict):
    """word -> 64-bit hash as uint64, filled as words are met; emptied when it gets large."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def array(self, ws: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


GAP = re.compile(rb"[\x20\x09-\x0D]")
#: White space between words, and one random number per byte value for the word hashes.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTE = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C17
CHUNK = 1 << 16
_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base modulo 2 ** 64, and of its inverse."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, CHUNK + (1 << 12)), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word [^\\x20\\x09-\\x0D]+ of UTF-8 data with A-Z lower-cased, and where it starts.

    A polynomial of the word's bytes, read from running sums, so no word becomes a Python object.
    Data is taken in chunks that end at white space; memory is that of a chunk or of the longest word.
    """
    hashes, places, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(data):
        end = at + CHUNK
        gap = GAP.search(data, end) if end < len(data) else None
        end = gap.start() if gap else len(data)
        part = np.frombuffer(data[at:end].lower(), np.uint8)
        space = SPACE[part]
        edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
        start, stop = edge[::2], edge[1::2]
        power, inverse = powers(len(part))
        run = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power, out=run[1:])
        h = (run[stop] - run[start]) * inverse[start]
        hashes.append(mix64(h + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        places.append(start + at)
        at = end
    return np.concatenate(hashes), np.concatenate(places)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser over an array of uint64 (wraps around)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def release_memory() -> None:
    """Give freed memory back to the system: a worker outlives its task, and what runs next needs the room."""
    gc.collect()
    if not gc.get_freeze_count():       # modules stay, and needn't be gone through after each task
        gc.freeze()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def text_slices(texts: pa.Array, most: int) -> Iterator[tuple[int, list]]:
    """Number of the first text and the texts (null: empty) of consecutive rows of about ``most`` bytes in total.

    Only one portion at a time becomes Python strings, or bytes if the array is binary.
    """
    empty = b"" if pa.types.is_binary(texts.type) else ""
    for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), most):
        yield a, [t or empty for t in texts.slice(a, b - a).to_pylist()]


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """(start, end) ranges of consecutive items of about ``most`` in total, each at least one item."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
