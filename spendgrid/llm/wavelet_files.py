"""Token ids of documents in wavelet-matrix files.

Documents are range-partitioned by id and sorted, encoded, and written in
shards of about ``shard_tokens`` ids. A shard is one file: the bit-planes of a
wavelet matrix in compressed blocks, the count of ones before each block, and
where each document begins. :class:`WaveletFile` answers access, count (rank)
and occurrence (select) queries from such a file and reads only the blocks it
needs; ``tokens`` rebuilds all ids.

A task writes a shard under a name of its own and then renames it, so a task
that is run again after a lost executor replaces the file by an equal one. The
folder is below ``spark.checkpoint.dir`` unless given.

Tokenizing a text in parts: the tokenizer's pattern never spans white space or
a change between an ASCII letter or digit and ASCII punctuation other than the
apostrophe, and it lower-cases. So each distinct part is encoded once; parts
met before are found again by a 64-bit hash, up to a bounded number of them.
Texts that could hold a special token are encoded whole.

Defined cases: a null text counts as empty (only the end id is written); null
ids come first; rows of equal id are ordered by text; further columns do not
matter; an empty table gives no files and no rows.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendgrid.llm.common import Scratch, checkpoint_dir, hash_spans, read_table

MAGIC = b"WVMX0001"
BLOCK_BYTES = 1 << 13
BLOCK_BITS = 8 * BLOCK_BYTES
SHARD_TOKENS = 1 << 20
BATCH_BYTES = 3 << 20  # encoded at once; the encoder holds arrays of 8 bytes for each byte
END_ID = 2


# --- the file format -----------------------------------------------------------

def pack(ids: np.ndarray, doc_starts: np.ndarray, doc_ids: list) -> bytes:
    """A shard's file: header, document table, block directory, blocks.

    Level l of the matrix holds bit ``width - 1 - l`` of every id, in the order
    that stable partition by the levels above it gives.
    """
    n = len(ids)
    width = max(1, int(ids.max()).bit_length()) if n else 1
    level_ids = ids.astype(np.uint16 if width <= 16 else np.uint32)
    compress = zstandard.ZstdCompressor(level=1).compress
    blocks: list[bytes] = []
    ones: list[np.ndarray] = []
    zeros = np.zeros(width, dtype=np.int64)
    for level in range(width):
        bits = (level_ids & level_ids.dtype.type(1 << (width - 1 - level))) != 0
        plane = np.packbits(bits)
        cuts = range(0, len(plane), BLOCK_BYTES)
        blocks += [compress(plane[c:c + BLOCK_BYTES].tobytes()) for c in cuts]
        counts = np.add.reduceat(np.bitwise_count(plane), np.arange(0, len(plane), BLOCK_BYTES), dtype=np.int64) if n else np.zeros(0, np.int64)
        ones.append(np.concatenate(([0], np.cumsum(counts))))
        low, high = level_ids[np.flatnonzero(~bits)], level_ids[np.flatnonzero(bits)]
        zeros[level] = len(low)
        level_ids = np.concatenate((low, high))
    table = pa.table({"doc_id": pa.array(doc_ids), "start": pa.array(doc_starts, pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    docs = sink.getvalue().to_pybytes()
    directory = np.concatenate(([0], np.cumsum([len(b) for b in blocks]))).astype("<i8").tobytes()
    rank = np.concatenate(ones).astype("<i8").tobytes() if ones else b""
    head = struct.pack("<8sqqqqqq", MAGIC, n, width, len(docs), len(zeros.tobytes()), len(rank), len(directory))
    return b"".join([head, docs, zeros.astype("<i8").tobytes(), rank, directory, *blocks])


class WaveletFile:
    """Queries on one shard's bytes. Positions count from the shard's start."""

    def __init__(self, data: bytes | memoryview):
        size = struct.calcsize("<8sqqqqqq")
        magic, self.n, self.width, *sizes = struct.unpack("<8sqqqqqq", data[:size])
        if magic != MAGIC:
            raise ValueError("not a wavelet file")
        parts = []
        for part in sizes:
            parts.append(data[size:size + part])
            size += part
        self.documents = pa.ipc.open_stream(pa.py_buffer(parts[0])).read_all()
        self.zeros = np.frombuffer(parts[1], "<i8")
        self.blocks = -(-self.n // BLOCK_BITS)
        self.ones = np.frombuffer(parts[2], "<i8").reshape(self.width, self.blocks + 1)
        self._directory = np.frombuffer(parts[3], "<i8")
        self._data, self._begin = data, size
        self._block = lru_cache(256)(self._read_block)

    def _read_block(self, level: int, block: int) -> np.ndarray:
        k = level * self.blocks + block
        begin, end = self._begin + self._directory[k:k + 2]
        return np.frombuffer(zstandard.decompress(self._data[begin:end]), np.uint8)

    def _rank(self, level: int, i: int) -> tuple[int, int]:
        """Ones before position i of a plane, and its bit there (0 at the end)."""
        block, at = divmod(i, BLOCK_BITS)
        if block == self.blocks:
            return int(self.ones[level, block]), 0
        plane = self._block(level, block)
        byte, bit = divmod(at, 8)
        if byte == len(plane):
            return int(self.ones[level, block + 1]), 0
        before = int(np.bitwise_count(plane[:byte]).sum()) + (int(plane[byte]) >> (8 - bit)).bit_count()
        return int(self.ones[level, block]) + before, (int(plane[byte]) >> (7 - bit)) & 1

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.width):
            before, bit = self._rank(level, i)
            value = value << 1 | bit
            i = int(self.zeros[level]) + before if bit else i - before
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` before i lie in the last order."""
        begin, end = 0, i
        for level in range(self.width):
            a, b = self._rank(level, begin)[0], self._rank(level, end)[0]
            if token >> (self.width - 1 - level) & 1:
                zeros = int(self.zeros[level])
                begin, end = zeros + a, zeros + b
            else:
                begin, end = begin - a, end - b
        return begin, end

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        """Occurrences of ``token`` in [begin, end)."""
        if token < 0 or token >> self.width:
            return 0
        upto = lambda i: (lambda r: r[1] - r[0])(self._range(token, i))
        return upto(self.n if end is None else end) - upto(begin)

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of this value in a plane."""
        blocks = np.arange(self.blocks + 1, dtype=np.int64) * BLOCK_BITS
        ranks = self.ones[level] if bit else np.minimum(blocks, self.n) - self.ones[level]
        block = int(np.searchsorted(ranks, k, side="right")) - 1
        bits = np.unpackbits(self._block(level, block))[:self.n - block * BLOCK_BITS]
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - int(ranks[block])])

    def occurrence(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``token``."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, self.n)[0] + k
        for level in reversed(range(self.width)):
            bit = token >> (self.width - 1 - level) & 1
            i = self._select(level, bit, i - int(self.zeros[level]) * bit)
        return i

    def tokens(self) -> np.ndarray:
        """All ids, rebuilt from the last plane to the first."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        value = np.zeros(self.n, dtype=kind)
        for level in reversed(range(self.width)):
            plane = b"".join(self._read_block(level, b).tobytes() for b in range(self.blocks))
            bits = np.unpackbits(np.frombuffer(plane, np.uint8), count=self.n).astype(bool)
            zeros = int(self.zeros[level])
            up = np.empty_like(value)
            up[np.flatnonzero(~bits)] = value[:zeros]
            up[np.flatnonzero(bits)] = value[zeros:] | kind(1 << (self.width - 1 - level))
            value = up
        return value


# --- encoding ---------------------------------------------------------------------

_KIND = np.full(256, 3, dtype=np.uint8)  # 0 space, 1 punctuation, 2 letter or digit, 3 other
_KIND[33:127] = 1
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 2
_KIND[ord("'")] = 3
_KIND[[32, *range(9, 14)]] = 0
#: By the kinds of two neighbours: whether a part begins at the second.
_CUT = np.zeros(16, dtype=bool)
_CUT[[0 * 4 + 1, 0 * 4 + 2, 0 * 4 + 3, 1 * 4 + 2, 2 * 4 + 1]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class PartEncoder:
    """Ids of texts, for a lower-casing tokenizer with this split pattern."""

    def __init__(self, path: str, cache: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._most = cache
        self._reset()

    def _reset(self) -> None:
        self._keys = np.zeros(0, np.uint64)  # sorted hashes of the parts met so far
        self._at = np.zeros(0, np.int64)  # and their rows in the two arrays below
        self._ends = array("q", [0])
        self._pool = array("I")

    def _rows(self, parts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the ids of each part stand in the pool."""
        if len(self._keys) + len(parts) > self._most:
            self._reset()
        keys = hash_spans(data, offsets[:-1], offsets[1:], lower=False)
        place = np.searchsorted(self._keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = place < len(self._keys)
        known[inside] = self._keys[place[inside]] == keys[inside]
        rows = np.empty(len(keys), dtype=np.int64)
        rows[known] = self._at[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            rows[new] = np.arange(len(new)) + (len(self._ends) - 1)
            texts = [p.decode() for p in parts.take(pa.array(new)).to_pylist()]
            for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                self._pool.extend(e.ids)
                self._ends.append(len(self._pool))
            order = new[np.argsort(keys[new], kind="stable")]
            self._keys, self._at = (np.insert(old, place[order], fresh) for old, fresh in ((self._keys, keys[order]), (self._at, rows[order])))
        return rows

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each begins
        (one more entry for the end)."""
        whole = {i: self.tokenizer.encode(t.decode(), add_special_tokens=False).ids
                 for i, t in enumerate(texts) if any(s in t for s in self.special)}
        offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([0 if i in whole else len(t) + 1 for i, t in enumerate(texts)], out=offsets[1:])
        data = _LOWER[np.frombuffer(b"".join(t + b"\n" for i, t in enumerate(texts) if i not in whole), dtype=np.uint8)]
        if len(data):
            kind = _KIND[data]
            cut = np.flatnonzero(_CUT[kind[:-1] * np.uint8(4) + kind[1:]]) + 1
            start = np.concatenate(([0], cut)) if kind[0] else cut
            real = kind != 0
            before = np.cumsum(real, dtype=np.int64)
            parts = pa.Array.from_buffers(pa.large_binary(), len(start), [
                None, pa.py_buffer(np.append(before[start] - 1, before[-1])), pa.py_buffer(data[real])])
            coded = parts.dictionary_encode()
            table = coded.dictionary
            table_offsets = np.frombuffer(table.buffers()[1], np.int64)[:len(table) + 1]
            rows = self._rows(table, np.frombuffer(table.buffers()[2], np.uint8), table_offsets)
            ends_of, pool = np.array(self._ends), np.array(self._pool, dtype=np.uint32)
            first, sizes = ends_of[rows], ends_of[rows + 1] - ends_of[rows]
            which = coded.indices.to_numpy()
            size = sizes[which]
            ends = np.cumsum(size)
            at = np.repeat(first[which] - (ends - size), size)
            at += np.arange(len(at))
            flat = pool[at]
            upto = np.concatenate(([0], ends))[np.searchsorted(start, offsets)]
        else:
            flat, upto = np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        if not whole:
            return flat, upto
        each = [np.array(whole[i], np.uint32) if i in whole else flat[upto[i]:upto[i + 1]] for i in range(len(texts))]
        return np.concatenate([np.zeros(0, np.uint32), *each]), np.concatenate(([0], np.cumsum([len(x) for x in each]))).astype(np.int64)


@lru_cache(2)
def part_encoder(path: str) -> PartEncoder:
    return PartEncoder(path)


def _save(folder: str, name: str, data: bytes) -> str:
    """Write below ``folder`` under a temporary name, then rename."""
    files, root = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    temporary = f"{root}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(temporary, compression=None) as out:
        out.write(data)
    target = f"{root}/{name}"
    if files.get_file_info(target).type != pyarrow.fs.FileType.NotFound:  # of a lost attempt; not every file system replaces
        files.delete_file(target)
    files.move(temporary, target)
    return f"{folder.rstrip('/')}/{name}"


def load(path: str) -> WaveletFile:
    files, at = pyarrow.fs.FileSystem.from_uri(path)
    with files.open_input_stream(at, compression=None) as f:
        return WaveletFile(f.read())


def _writer(tokenizer: str, folder: str, shard_tokens: int, end_id: int, schema: pa.Schema):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        encoder = part_encoder(tokenizer)
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def texts() -> Iterator[tuple[list, list[bytes]]]:
            for batch in batches:
                ids, got, size = [], [], 0
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids.append(doc_id)
                    got.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
                    size += len(got[-1])
                    if size >= BATCH_BYTES:
                        yield ids, got
                        ids, got, size = [], [], 0
                if ids:
                    yield ids, got

        def flush() -> pa.RecordBatch:
            nonlocal shard
            doc_ids = [x for h in held for x in h[0]]
            tokens = np.concatenate([h[1] for h in held])
            lengths = np.concatenate([h[2] for h in held])
            starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
            path = _save(folder, f"part-{part:06d}-{shard:06d}.wvm", pack(tokens, starts, pa.array(doc_ids, schema.field("doc_id").type)))
            row = pa.RecordBatch.from_pylist([{"part": part, "shard": shard, "path": path, "tokens": len(tokens), "docs": len(doc_ids)}])
            shard += 1
            held.clear()
            return row

        for ids, got in texts():
            flat, upto = encoder.encode(got)
            lengths = np.diff(upto) + 1
            tokens = np.full(int(lengths.sum()), end_id, dtype=np.uint32)
            keep = np.ones(len(tokens), dtype=bool)
            keep[np.cumsum(lengths) - 1] = False
            tokens[keep] = flat
            ends = np.cumsum(lengths)
            begin = 0
            while begin < len(ids):  # whole documents up to the shard's size, one at least
                room = max(0, shard_tokens - sum(len(h[1]) for h in held))
                base = int(ends[begin - 1]) if begin else 0
                end = int(np.searchsorted(ends, base + room, side="right"))
                if end == begin:
                    if held:
                        yield flush()
                        continue
                    end = begin + 1
                held.append((ids[begin:end], tokens[base:int(ends[end - 1])], lengths[begin:end]))
                begin = end
        if held:
            yield flush()
    return write


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the files and returns the lazily computed manifest ``part, shard,
    path, tokens, docs``; shards in (part, shard) order hold the documents in
    ascending order of ``doc_id``. Store the manifest once; each evaluation
    writes the files."""
    kind = docs.schema["doc_id"].dataType
    schema = pa.schema([("doc_id", {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()])])
    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(_writer(tokenizer, folder, shard_tokens, end_id, schema),
                              "part long, shard long, path string, tokens long, docs long")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            file = load(path)
            ids = file.tokens().astype("<u4")
            starts = file.documents["start"].to_numpy()
            ends = np.append(starts[1:], file.n)
            yield pa.RecordBatch.from_arrays([
                file.documents["doc_id"].combine_chunks(), pa.array(starts + base, pa.int64()), pa.array(ends - starts, pa.int64()),
                pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64()), pa.array([path] * len(starts))],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "path"])


def read_documents(manifest: DataFrame, doc_id: str = "bigint") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, path`` of every document, from the
    files, one file after the other in each task. Only the manifest, a row for
    each shard, is put in one order."""
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(tasks).mapInArrow(
        _reader, f"doc_id {doc_id}, start bigint, n_tokens bigint, ids_crc32 bigint, path string")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark)}/wavelet-files-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("/") else os.path.abspath(folder)
    docs = read_table(spark, sf_dir, "documents")
    manifest = Scratch(spark, "wavelet-manifest").write(write_shards(docs, default_tokenizer(), folder), "manifest")
    return read_documents(manifest).drop("path")
