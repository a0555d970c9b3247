"""Helpers shared by the operators of this subpackage.

Words are the maximal runs of bytes other than space and ``\\x09-\\x0D``; on
UTF-8 that is what ``bytes.split()`` gives, and ``bytes.lower()`` lowers A-Z
alone. :func:`hash_words` does the same for a whole Arrow batch in numpy.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid.session import shared_checkpoint_dir

WORD_SEPARATOR = r"[\x20\x09-\x0D]+"


# --- tables -----------------------------------------------------------------

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder that all executors share, as the session names it."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.checkpoint.dir", None)
            or shared_checkpoint_dir(spark)).rstrip("/")


@contextmanager
def _finished_shuffles_removed(spark: SparkSession):
    """Shuffle files of a job written here go when it ends, not when the driver
    happens to collect its memory: nothing reads them once the table stands."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Written intermediate tables below the shared checkpoint folder.

    A written table cuts lineage and outlives any executor. ``drop`` removes a
    table that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with _finished_shuffles_removed(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        for frame in frames:
            path = jvm.org.apache.hadoop.fs.Path(frame._scratch_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def filtered_scans(spark: SparkSession):
    """Joins written here may filter the scan of a large table by a Bloom
    filter over the other side, whose size Spark bounds, before they shuffle
    it. Spark leaves it out where the other side is too large or not filtered."""
    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_of(column: str = "text"):
    """The text, with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: str = "text"):
    """64 bits of the text as it is."""
    return F.xxhash64(F.col(column).cast("string"))


# --- words of an Arrow batch -------------------------------------------------

_RNG = np.random.default_rng(20240607)
_BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE_VALUES_LOWER = _BYTE_VALUES.copy()
_BYTE_VALUES_LOWER[65:91] = _BYTE_VALUES[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_GRAM_FACTORS = _RNG.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_BASE, _CHUNK)
_INVERSE_POWERS = _powers(_BASE_INVERSE, _CHUNK)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, each followed by a newline, and the
    offset at which each begins (one more entry for the end)."""
    texts = [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return data, offsets


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) offsets of all words in ``data``, which must
    end with a separator unless it is empty."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = _IS_SPACE[data]
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        change = np.concatenate(([0], change))
    return change[0::2], change[1::2]


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and disjoint.

    A polynomial over random byte values, by differences of running sums:
    ``sum(value[b_j] * base**j) * base**-start``. It runs in chunks; a span
    longer than a chunk is hashed by itself.
    """
    values = _BYTE_VALUES_LOWER if lower else _BYTE_VALUES
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        begin = int(start[i])
        j = int(np.searchsorted(end, begin + _CHUNK, side="right"))
        if j <= i:
            total = np.uint64(0)
            for k, at in enumerate(range(begin, int(end[i]), _CHUNK)):
                part = values[data[at:min(at + _CHUNK, int(end[i]))]]
                with np.errstate(over="ignore"):
                    total = mix(np.array([total + (part * _POWERS[:len(part)]).sum(dtype=np.uint64) + np.uint64(k)]))[0]
            out[i] = total
            i += 1
            continue
        stop = int(end[j - 1])
        running = np.zeros(stop - begin + 1, dtype=np.uint64)
        np.cumsum(values[data[begin:stop]] * _POWERS[:stop - begin], out=running[1:])
        s, e = start[i:j] - begin, end[i:j] - begin
        out[i:j] = (running[e] - running[s]) * _INVERSE_POWERS[s]
        i = j
    return mix(out + (end - start).astype(np.uint64))


def hash_words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts of ``column``, and for each text
    the range of its words: text i has ``hashes[first[i]:first[i + 1]]``."""
    data, offsets = text_bytes(column)
    start, end = word_spans(data)
    return hash_spans(data, start, end, lower), np.searchsorted(start, offsets)


def hash_grams(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all windows of ``n`` successive word hashes."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(size, dtype=np.uint64)
    for k in range(n):
        out += words[k:k + size] * _GRAM_FACTORS[k]
    return mix(out)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct ``n``-word shingles; the whole sequence as one if it
    has fewer words; empty without words."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    if len(words) < n:
        return hash_grams(words, len(words)) ^ np.uint64(len(words))
    return np.unique(hash_grams(words, n))
