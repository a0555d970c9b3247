"""Katz backoff scoring of documents.

A bigram model over lower-cased words and a document end: Good-Turing
discounted counts (up to ``K``), and for each context the backoff weight that
makes its distribution sum to one exactly. A text's score is the sum over its
tokens of log10 p(word | word before): the discounted share of the count where
the pair was seen in training, else the context's backoff weight times the
discounted unigram share; words never seen share the unigram mass left over,
as one unknown word. Contexts never seen back off with weight one.

Counts lie in tables partitioned by hash. Documents are cut into batches, which
are stored once as word hashes and token numbers. A batch asks a table's
partitions for the counts of its own distinct words or pairs, packed by
partition; the partition first adds up what all batches bring from training
documents, then answers each batch. Answers are written by batch, and the task
that reads a batch reads them from the shared folder. So what is moved is a
distinct word or pair per batch, not a token, and grows with the corpus.
A context that holds very many tokens is dealt to several partitions by the
word that follows; how many follows from its count.

Words are told apart by 64-bit hashes. Defined cases: a null text counts as
empty and has the end alone; a null id is a training document; repeated rows
count and are scored each; without training documents all scores are those of
the unknown word; further columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid.llm.common import Scratch, hash_words, mix, read_table
from spendgrid.llm.near_duplicates import _slices

K = 5
START, END = (np.uint64(x) for x in mix(np.array([101, 102], dtype=np.uint64)))
BATCH_BYTES = 12 << 20
BUCKET_ENTRIES = 1 << 20
CONTEXT_ENTRIES = 1 << 20
_ID_BITS = 40


def pack(values: np.ndarray) -> bytes:
    """Byte planes, compressed: small or sorted numbers take little room."""
    raw = np.ascontiguousarray(values)
    planes = np.ascontiguousarray(raw.view(np.uint8).reshape(len(raw), raw.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(raw.dtype.str.encode().ljust(4) + planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = zstandard.decompress(data)
    kind = np.dtype(raw[:4].decode().strip())
    planes = np.frombuffer(raw, np.uint8, offset=4).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


# --- discounts ------------------------------------------------------------------

def good_turing(count_of_counts: np.ndarray) -> np.ndarray:
    """Factors for counts 0 to K (0: unused); ``count_of_counts[r]`` types
    occur r times, r up to K + 1. Where the estimate does not exist or leaves
    (0, 1], half a count is taken off instead."""
    n = np.asarray(count_of_counts, dtype=np.float64)
    r = np.arange(K + 1)
    out = np.ones(K + 1)
    out[1:] = (r[1:] - 0.5) / r[1:]
    if (n[1:K + 2] > 0).all():
        tail = (K + 1) * n[K + 1] / n[1]
        found = ((r[1:] + 1) * n[2:K + 2] / (r[1:] * n[1:K + 1]) - tail) / (1 - tail) if tail != 1 else np.zeros(K)
        if ((found > 0) & (found <= 1)).all():
            out[1:] = found
    return out


@dataclass
class Unigrams:
    """Discounted shares; the unknown word gets what they leave of 1."""

    factors: np.ndarray
    tokens: int
    unknown: float

    def share(self, count: np.ndarray) -> np.ndarray:
        factor = np.where(count <= K, self.factors[np.minimum(count, K)], 1.0)
        return np.where(count > 0, factor * count / (self.tokens + 1), self.unknown)


def weights(n: np.ndarray, large: np.ndarray, seen: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(denominator, backoff weight) of contexts: ``n[:, r - 1]`` words follow r
    times, ``large`` tokens belong to words that follow more than K times,
    ``seen`` is the unigram share of all words that follow."""
    r = np.arange(1, K + 1)
    total = n @ r + large
    kept = n @ (r * factors[1:]) + large
    below = total + (kept >= total)  # nothing was discounted: one more outcome
    return below, np.where(total > 0, (1 - kept / np.maximum(below, 1)) / np.maximum(1 - seen, 1e-300), 1.0)


# --- batches ---------------------------------------------------------------------

_BATCH = pa.schema([("batch", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                    ("words", pa.binary()), ("tokens", pa.binary())])


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and crc32(str(doc_id).encode()) % 7 == 2


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, k = TaskContext.get().partitionId(), 0
    for batch in _slices(batches, rows=1 << 16, size=BATCH_BYTES):
        hashes, first = hash_words(batch.column(1))
        sizes = np.diff(first) + 1
        stream = np.insert(hashes, first[1:], END)
        words, tokens = np.unique(np.append(stream, [START, END]), return_inverse=True)
        yield _rows([{"batch": task << 24 | k, "doc_ids": batch.column(0).to_pylist(), "sizes": sizes.tolist(),
                      "words": words.tobytes(), "tokens": pack(tokens[:-2].astype(np.uint32))}], _BATCH)
        k += 1


class Batch:
    """A stored batch: its distinct words, in order, and tokens as their numbers."""

    def __init__(self, row: dict):
        self.id, self.doc_ids = row["batch"], row["doc_ids"]
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.tokens = unpack(row["tokens"])
        self.held = np.array([held_out(d) for d in self.doc_ids], dtype=bool)
        self.training = np.repeat(~self.held, self.sizes)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.training], minlength=len(self.words)).astype(np.uint32)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (context, word) as one number, and that of each token."""
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = np.searchsorted(self.words, START)
        return np.unique(before.astype(np.uint64) * np.uint64(len(self.words)) + self.tokens, return_inverse=True)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Batch(batch.slice(k, 1).to_pylist()[0])


def _answers(path: str, batch: int) -> list[dict]:
    """The rows written for a batch, by partition."""
    files, root = pyarrow.fs.FileSystem.from_uri(f"{path}/batch={batch}")
    found = files.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True))
    rows = [row for f in found if f.base_name.endswith(".parquet") for row in pyarrow.parquet.ParquetFile(files.open_input_file(f.path)).read().to_pylist()]
    return sorted(rows, key=lambda r: r["bucket"])


# --- words --------------------------------------------------------------------------

_ASKED = "bucket bigint, batch bigint, keys binary, counts binary"
_ASKED_SCHEMA = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _ask_words(bits: int):
    def run(batches):
        for b in _read(batches):
            cuts = np.searchsorted(b.words, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(1, np.int64)
            cuts, counts = np.append(cuts, len(b.words)), b.word_counts()
            yield _rows([{"bucket": k, "batch": b.id, "keys": b.words[x:y].tobytes(), "counts": pack(counts[x:y])}
                         for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x], _ASKED_SCHEMA)
    return run


_TOLD = "bucket bigint, batch bigint, ids binary, counts binary, stats array<bigint>"
_TOLD_SCHEMA = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary()), ("stats", pa.list_(pa.int64()))])


def _statistics(counts: np.ndarray) -> list[int]:
    """Tokens, types, and types that occur 1 to K + 1 times."""
    return [int(counts.sum()), int((counts > 0).sum()), *(int((counts == r).sum()) for r in range(1, K + 2))]


def _tell_words(key, group):
    bucket = key[0].as_py()
    asked = [(b, np.frombuffer(k, np.uint64), unpack(c)) for b, k, c in zip(*(group.column(x).to_pylist() for x in ("batch", "keys", "counts")))]
    words, inverse = np.unique(np.concatenate([k for _, k, _ in asked]), return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate([c for _, _, c in asked]), minlength=len(words)).astype(np.int64)
    rows = [{"bucket": bucket, "batch": -1, "stats": _statistics(total)}]
    for batch, keys, _ in asked:
        at = np.searchsorted(words, keys)
        rows.append({"bucket": bucket, "batch": batch, "ids": pack(at.astype(np.uint64) | np.uint64(bucket << _ID_BITS)), "counts": pack(total[at])})
    return pa.Table.from_pylist(rows, schema=_TOLD_SCHEMA)


@lru_cache(2)
def _words_of(path: str, batch: int) -> tuple[np.ndarray, np.ndarray]:
    told = _answers(path, batch)
    return np.concatenate([unpack(r["ids"]) for r in told]), np.concatenate([unpack(r["counts"]) for r in told])


# --- pairs ---------------------------------------------------------------------------

_PAIRS = "bucket bigint, batch bigint, contexts binary, words binary, word_counts binary, counts binary"
_PAIRS_SCHEMA = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), *((x, pa.binary()) for x in ("contexts", "words", "word_counts", "counts"))])


def _deal(b: Batch, pairs: np.ndarray, ids: np.ndarray, counts: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, word, partition) of distinct pairs. A context goes to one
    partition, or to as many as its count asks for."""
    context, word = np.divmod(pairs, np.uint64(len(b.words)))
    context, word = context.astype(np.int64), word.astype(np.int64)
    held = counts.copy()
    held[np.searchsorted(b.words, START)] = counts[np.searchsorted(b.words, END)]  # one for each text
    spread = (held[context] // CONTEXT_ENTRIES + 1).astype(np.uint64)
    salt = np.where(spread > 1, mix(ids[word]) % spread, 0).astype(np.uint64)
    return context, word, (mix(ids[context] + mix(salt)) % np.uint64(buckets)).astype(np.int64)


def _ask_pairs(path: str, buckets: int):
    def run(batches):
        for b in _read(batches):
            ids, counts = _words_of(path, b.id)
            pairs, inverse = b.pairs()
            many = np.bincount(inverse[b.training], minlength=len(pairs)).astype(np.uint32)
            context, word, bucket = _deal(b, pairs, ids, counts, buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                part = order[cuts[k]:cuts[k + 1]]
                yield _rows([{"bucket": k, "batch": b.id, "contexts": pack(ids[context[part]]), "words": pack(ids[word[part]]),
                              "word_counts": pack(counts[word[part]]), "counts": pack(many[part])}], _PAIRS_SCHEMA)
    return run


_PAIRS_TOLD = "bucket bigint, batch bigint, counts binary, stats array<bigint>, contexts binary, sums binary"
_PAIRS_TOLD_SCHEMA = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("counts", pa.binary()), ("stats", pa.list_(pa.int64())),
                                ("contexts", pa.binary()), ("sums", pa.binary())])


def _tell_pairs(unigrams: Unigrams):
    def run(key, group):
        bucket = key[0].as_py()
        batches = group.column("batch").to_pylist()
        parts = {x: [unpack(v) for v in group.column(x).to_pylist()] for x in ("contexts", "words", "word_counts", "counts")}
        context, word, word_count, count = (np.concatenate(parts[x]) for x in ("contexts", "words", "word_counts", "counts"))
        order = np.lexsort((word, context))
        context_, word_ = context[order], word[order]
        new = np.append(True, (context_[1:] != context_[:-1]) | (word_[1:] != word_[:-1]))
        which = np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        total = np.bincount(which, weights=count).astype(np.int64)
        rows = [{"bucket": bucket, "batch": -1, "stats": _statistics(total)}]
        # what each context needs for its weight
        first = order[new]
        of, share = context[first], unigrams.share(word_count[first])
        start = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        add = lambda x: np.add.reduceat(x, start)
        sums = np.stack([*(add((total == r).astype(np.float64)) for r in range(1, K + 1)),
                         add(np.where(total > K, total, 0).astype(np.float64)), add(np.where(total > 0, share, 0.0))], axis=1)
        contexts = of[start]
        home = (contexts >> np.uint64(_ID_BITS)).astype(np.int64)
        for k in np.unique(home).tolist():
            own = home == k
            rows.append({"bucket": k, "batch": -2, "contexts": pack(contexts[own]), "sums": pack(sums[own].ravel())})
        at = 0
        for batch, part in zip(batches, parts["counts"]):
            rows.append({"bucket": bucket, "batch": batch, "counts": pack(total[which[at:at + len(part)]])})
            at += len(part)
        return pa.Table.from_pylist(rows, schema=_PAIRS_TOLD_SCHEMA)
    return run


# --- contexts -----------------------------------------------------------------------

_CONTEXTS = "bucket bigint, batch bigint, contexts binary, sums binary"
_CONTEXTS_SCHEMA = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("contexts", pa.binary()), ("sums", pa.binary())])
_WEIGHTS = "bucket bigint, batch bigint, below binary, weight binary"
_WEIGHTS_SCHEMA = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("below", pa.binary()), ("weight", pa.binary())])


def _ask_contexts(path: str):
    def run(batches):
        for b in _read(batches):
            for told in _answers(path, b.id):
                yield _rows([{"bucket": told["bucket"], "batch": b.id, "contexts": told["ids"]}], _CONTEXTS_SCHEMA)
    return run


def _tell_contexts(factors: np.ndarray):
    def run(key, group):
        rows = list(zip(*(group.column(x).to_pylist() for x in ("batch", "contexts", "sums"))))
        parts = [(unpack(c), unpack(s).reshape(-1, K + 2)) for b, c, s in rows if b == -2]
        context = np.concatenate([np.zeros(0, np.uint64), *(c for c, _ in parts)])
        sums = np.concatenate([np.zeros((0, K + 2)), *(s for _, s in parts)])
        own, inverse = np.unique(context, return_inverse=True)
        total = np.stack([np.bincount(inverse, weights=sums[:, k], minlength=len(own)) for k in range(K + 2)], axis=1)
        total = np.concatenate([total, np.zeros((1, K + 2))])  # the last: contexts never seen
        below, weight = weights(total[:, :K], total[:, K], total[:, K + 1], factors)
        out = []
        for batch, contexts, _ in rows:
            if batch == -2:
                continue
            asked = unpack(contexts)
            at = np.searchsorted(own, asked)
            at = np.where((at < len(own)) & (np.append(own, np.uint64(0))[np.minimum(at, len(own))] == asked), at, len(own))
            out.append({"bucket": key[0].as_py(), "batch": batch, "below": pack(below[at]), "weight": pack(weight[at])})
        return pa.Table.from_pylist(out, schema=_WEIGHTS_SCHEMA)
    return run


# --- scores ---------------------------------------------------------------------------

_SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def _score(words_path: str, pairs_path: str, weights_path: str, buckets: int, unigrams: Unigrams, types: int, factors: np.ndarray):
    def run(batches):
        for b in _read(batches):
            ids, counts = _words_of(words_path, b.id)
            pairs, inverse = b.pairs()
            context, word, bucket = _deal(b, pairs, ids, counts, buckets)
            order = np.argsort(bucket, kind="stable")
            seen = np.empty(len(pairs), dtype=np.int64)
            seen[order] = np.concatenate([unpack(r["counts"]) for r in _answers(pairs_path, b.id)])
            told = _answers(weights_path, b.id)
            below, weight = (np.concatenate([unpack(r[x]) for r in told]) for x in ("below", "weight"))
            factor = np.where(seen <= K, factors[np.minimum(seen, K)], 1.0)
            share = np.where(seen > 0, factor * seen / np.maximum(below[context], 1), weight[context] * unigrams.share(counts[word]))
            logs = np.log10(share)[inverse]
            base = np.log10((counts + 1) / (unigrams.tokens + types + 1))[b.tokens]
            known = (counts > 0)[b.tokens]
            first = np.cumsum(b.sizes) - b.sizes
            n = len(b.doc_ids)
            yield pa.RecordBatch.from_arrays([
                pa.array(b.doc_ids, pa.int64()), pa.array(b.held), pa.array(b.sizes), pa.array(np.add.reduceat(known, first, dtype=np.int64)),
                pa.array(np.full(n, unigrams.tokens)), pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(logs, first))],
                names=[c.split()[0] for c in _SCORES.split(", ")])
    return run


def katz_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    for each row of ``docs`` (``doc_id`` bigint)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "katz")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stored = scratch.write(texts.mapInArrow(
        _batches, "batch bigint, doc_ids array<bigint>, sizes array<bigint>, words binary, tokens binary"), "batches")
    sizes = stored.agg(F.sum(F.octet_length("words") / 8), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    if not sizes[1]:
        return spark.createDataFrame([], _SCORES)
    bits = int(np.ceil(np.log2(max(1, sizes[0] / BUCKET_ENTRIES))))
    buckets = int(max(1, -(-int(sizes[1]) // BUCKET_ENTRIES)))

    def by_batch(told: DataFrame, name: str, *columns: str) -> str:
        path = scratch.path(name)
        told.where("batch >= 0").select("batch", "bucket", *columns).repartition("batch").write.partitionBy("batch").parquet(path)
        return path

    def statistics(told: DataFrame) -> np.ndarray:
        return np.array([r["stats"] for r in told.where("batch = -1").select("stats").collect()], dtype=np.int64).sum(axis=0)

    told = scratch.write(stored.mapInArrow(_ask_words(bits), _ASKED).groupBy("bucket").applyInArrow(_tell_words, _TOLD), "words")
    words_path = by_batch(told, "words-by-batch", "ids", "counts")
    tokens, types, *ones = statistics(told).tolist()
    scratch.drop(told)
    factors = good_turing(np.array([0, *ones]))
    n = np.array(ones[:K], dtype=np.float64)
    r = np.arange(1, K + 1)
    kept = tokens - float(n @ (r * (1 - factors[1:])))
    unigrams = Unigrams(factors, tokens, 1 - kept / (tokens + 1))

    told = scratch.write(stored.mapInArrow(_ask_pairs(words_path, buckets), _PAIRS).groupBy("bucket").applyInArrow(
        _tell_pairs(unigrams), _PAIRS_TOLD), "pairs")
    pairs_path = by_batch(told, "pairs-by-batch", "counts")
    pair_factors = good_turing(np.array([0, *statistics(told)[2:].tolist()]))
    sums = told.where("batch = -2").select("bucket", "batch", "contexts", "sums")
    asked = stored.mapInArrow(_ask_contexts(words_path), _CONTEXTS)
    weights_path = by_batch(asked.union(sums).groupBy("bucket").applyInArrow(_tell_contexts(pair_factors), _WEIGHTS),
                            "weights-by-batch", "below", "weight")
    return stored.mapInArrow(_score(words_path, pairs_path, weights_path, buckets, unigrams, types, pair_factors), _SCORES)


def op6_katz_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(read_table(spark, sf_dir, "documents"))
