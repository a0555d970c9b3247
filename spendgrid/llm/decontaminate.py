"""Benchmark decontamination: seeds, then Smith-Waterman alignment.

Seeds are the rare ``SEED``-word windows of a test item (the whole item if it is
shorter). A first pass counts the items' windows in all documents. Of any two
neighbouring windows of an item that both occur, the one that occurs more than
``RARE`` times as often as the other is left out, unless its other neighbour
asks for it: no stretch of ``SEED + 1`` words is left without a seed, and copies
of the item raise both counts alike, so they do not take its seeds away. A
window whose neighbours occur nowhere stays, however frequent. Each seed that a
document holds asks for an alignment of the item with the passage around it, in
words. Words
are counted first: an alignment of ``k`` equal words needs ``k`` of the item's
words in the passage, so a passage with too few of them for the least score is
not aligned. A document is contaminated if an alignment scores at least half of
what a whole copy does (2 for an equal word, -1 for a changed, left out or added
one), which about one changed word in three does not prevent, and at least as
much as eight equal words or the whole item. A copy with ``SEED + 1`` words in a
row as they were is always met; one with ``SEED`` in a row is, unless a window
next to them is far rarer elsewhere; one without is not.

Test items go round in blocks of a bounded number of words, each as a
broadcast; documents are read where they lie and not shuffled.

Words are compared by 64-bit hashes, A-Z lower-cased. Defined cases: null and
empty items and texts match nothing; equal items are reported each; rows of
equal ids are searched one by one and reported once per pair of ids; a null id
is reported as null; further columns do not matter; an empty table on either
side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid.llm.common import Scratch, hash_grams, hash_words, read_table, text_key
from spendgrid.llm.near_duplicates import _slices

SEED = 3
RARE = 8
SHARE = 0.5
LEAST_WORDS = 8
BLOCK_WORDS = 500_000
EQUAL, OTHER = 2, -1
_CELLS = 1 << 21
_HITS = 1 << 19


def _windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, place in it) of all windows of n words within one text."""
    grams = hash_grams(hashes, n)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    size = len(grams)
    inside = text[:size] == text[n - 1:n - 1 + size]
    return grams[inside], text[:size][inside], (np.arange(size) - first[text[:size]])[inside]


class Items:
    """The seeds of a block of test items, by the length of the window."""

    def __init__(self, texts: list[str]):
        self.words, self.first = hash_words(pa.array(texts, pa.string()))
        size = np.diff(self.first)
        self.seeds = {}
        for n in range(1, SEED + 1):
            grams, item, place = _windows(self.words, self.first, n)
            own = np.minimum(size[item], SEED) == n
            if own.any():
                order = np.argsort(grams[own], kind="stable")
                self.seeds[n] = (grams[own][order], item[own][order], place[own][order])
        # each item's distinct words and how often it holds them, by (item, word)
        of = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((self.words, of))
        new = np.append(True, (np.diff(of[order]) > 0) | (self.words[order][1:] != self.words[order][:-1]))[:len(order)]
        begin = np.flatnonzero(new)
        self.known, code = np.unique(self.words, return_inverse=True)
        self.key = of[order][begin] * max(1, len(self.known)) + code[order][begin]
        self.many = np.diff(np.append(begin, len(order)))

    def windows(self) -> np.ndarray:
        """The distinct windows of ``SEED`` words, in order."""
        return np.unique(self.seeds[SEED][0]) if SEED in self.seeds else np.zeros(0, np.uint64)

    def keep_rare(self, counts: np.ndarray) -> None:
        """Leaves the rare ones as seeds; ``counts`` are those of ``windows()``."""
        if SEED not in self.seeds:
            return
        grams, item, place = self.seeds[SEED]
        many = counts[np.searchsorted(self.windows(), grams)].astype(np.float64)
        order = np.lexsort((place, item))
        x = np.where(many > 0, many, np.inf)[order]
        near = item[order][1:] == item[order][:-1]
        least = RARE * np.minimum(x[1:], x[:-1])
        left, right = np.append(near, False), np.append(False, near)  # is the first, the second of two
        rare = ~left & ~right
        rare[:-1] |= near & (x[:-1] <= least)
        rare[1:] |= near & (x[1:] <= least)
        own = np.empty(len(order), dtype=bool)
        own[order] = rare & np.isfinite(x)
        if own.any():
            self.seeds[SEED] = (grams[own], item[own], place[own])
        else:
            del self.seeds[SEED]

    def least(self, item: np.ndarray) -> np.ndarray:
        """The score that an alignment with the item has to reach."""
        size = np.diff(self.first)[item]
        return np.maximum(SHARE * EQUAL * size, EQUAL * np.minimum(LEAST_WORDS, size))

    def common(self, item: np.ndarray, hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How many words each item has in common with ``hashes[low:high]``,
        each as often as both hold it."""
        span = high - low
        place = np.repeat(low - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))
        pair = np.repeat(np.arange(len(item)), span)
        code = np.searchsorted(self.known, hashes)
        held = code < len(self.known)
        held[held] = self.known[code[held]] == hashes[held]
        inside = held[place]
        place, pair = place[inside], pair[inside]
        key = item[pair] * max(1, len(self.known)) + code[place]
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        same = self.key[at] == key
        entry, times = np.unique(pair[same] * len(self.key) + at[same], return_counts=True)
        both = np.minimum(times, self.many[entry % len(self.key)])
        return np.bincount(entry // len(self.key), weights=both, minlength=len(item)).astype(np.int64)


def _hits(items: Items, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, place in it, item, place in it) of seeds, about ``_HITS`` at a time."""
    for n, (grams, item, place) in items.seeds.items():
        found, text, at = _windows(hashes, first, n)
        lo = np.searchsorted(grams, found, side="left")
        hit = np.flatnonzero((lo < len(grams)) & (grams[np.minimum(lo, len(grams) - 1)] == found))
        lo, size = lo[hit], np.searchsorted(grams, found[hit], side="right") - lo[hit]
        ends, begin = np.cumsum(size), 0
        while begin < len(hit):
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _HITS, side="right")))
            many = size[begin:stop]
            which = np.repeat(lo[begin:stop] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            back = np.repeat(hit[begin:stop], many)
            yield text[back], at[back], item[which], place[which]
            begin = stop


def align(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman: the best local score of each pair of word sequences, and
    how many words of the second it has reached there."""
    width = max(map(len, b))
    right = np.zeros((len(b), width), dtype=np.uint64)
    real = np.zeros(right.shape, dtype=bool)
    for k, x in enumerate(b):
        right[k, :len(x)], real[k, :len(x)] = x, True
    left = np.zeros((len(a), max(map(len, a))), dtype=np.uint64)
    for k, x in enumerate(a):
        left[k, :len(x)] = x
    size = np.array([len(x) for x in a])
    slope = OTHER * np.arange(width + 1, dtype=np.int32)
    score = np.zeros((len(a), width + 1), dtype=np.int32)
    best, end = np.zeros(len(a), dtype=np.int32), np.zeros(len(a), dtype=np.int64)
    for i in range(left.shape[1]):
        step = np.where((left[:, i, None] == right) & real, EQUAL, OTHER)
        row = np.zeros_like(score)
        np.maximum(score[:, :-1] + step, score[:, 1:] + OTHER, out=row[:, 1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row - slope, axis=1) + slope  # words of the second alone
        score = np.where((i < size)[:, None], row, score)
        top = row.argmax(axis=1)
        value = row[np.arange(len(a)), top]
        better = (i < size) & (value > best)
        best[better], end[better] = value[better], top[better]
    return best, end


def _counter(windows):
    """How often each window occurs in the texts of a task."""
    def run(batches):
        known = windows.value
        counts = np.zeros(len(known), dtype=np.int64)
        for batch in _slices(batches, rows=4096):
            hashes, first = hash_words(batch.column(1))
            found = _windows(hashes, first, SEED)[0]
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            counts += np.bincount(at[known[at] == found], minlength=len(known))
        held = np.flatnonzero(counts)
        for begin in range(0, len(held), 1 << 16):
            part = held[begin:begin + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(counts[part])], names=["window", "many"])
    return run


def _corpus_counts(texts: DataFrame, windows: np.ndarray) -> np.ndarray:
    """The count of each window over all texts; no more rows than windows come back."""
    counts = np.zeros(len(windows), dtype=np.int64)
    if len(windows):
        sent = texts.sparkSession.sparkContext.broadcast(windows)
        rows = texts.mapInArrow(_counter(sent), "window bigint, many bigint").groupBy("window").agg(F.sum("many").alias("many")).collect()
        for r in rows:
            counts[r["window"]] = r["many"]
        sent.unpersist()
    return counts


def _searcher(items):
    def run(batches):
        block: Items = items.value
        lengths = np.diff(block.first)
        for batch in _slices(batches, rows=4096):
            hashes, first = hash_words(batch.column(1))
            found = []
            for text, at, item, place in _hits(block, hashes, first):
                # one alignment for each stretch of diagonals half as wide as the slack
                stretch = (at - place) // np.maximum(1, (lengths[item] // 2 + 2) // 2)
                asked = np.unique(np.stack([text, item, stretch], axis=1), axis=0)
                begin = 0
                while begin < len(asked):
                    stop = begin + max(1, _CELLS // (4 * int(lengths[asked[begin:begin + 2048, 1]].max()) + 16))
                    t, k, s = asked[begin:stop].T
                    begin = stop
                    slack = lengths[k] // 2 + 2
                    half = np.maximum(1, slack // 2)
                    low = np.maximum(s * half - slack, 0) + first[t]
                    high = np.minimum((s + 1) * half + lengths[k] + slack + first[t], first[t + 1])
                    need = block.least(k)
                    may = EQUAL * block.common(k, hashes, low, high) >= need
                    if not may.any():
                        continue
                    t, k, low, high, need = t[may], k[may], low[may], high[may], need[may]
                    score, end = align([block.words[block.first[x]:block.first[x + 1]] for x in k], [hashes[x:y] for x, y in zip(low, high)])
                    ok = np.flatnonzero(score >= need)
                    found += [(int(t[x]), int(k[x]), score[x] / (EQUAL * int(lengths[k[x]])), int(low[x] - first[t[x]] + end[x])) for x in ok]
            if found:
                t, k, share, end = zip(*found)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(t)), batch.column(2).take(pa.array(t)), pa.array(k, pa.int64()), pa.array(share, pa.float64()), pa.array(end, pa.int64())],
                    names=["doc_id", "text_hash", "k", "score", "end_word"])
    return run


def matches(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame | None:
    """``doc_id, text_hash, item_id, score, end_word`` for each place of a row's
    text at which an item is found; None without any item."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), text_key().alias("text_hash"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    items = benchmark.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n_blocks = -(-words // block_words)
    found = None
    for block in range(n_blocks):
        rows = sorted(items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect(),
                      key=lambda r: (r["item_id"] is not None, r["item_id"], r["text"]))
        seeds = Items([r["text"] for r in rows])
        seeds.keep_rare(_corpus_counts(texts, seeds.windows()))
        sent = spark.sparkContext.broadcast(seeds)
        ids = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(rows)], f"k bigint, item_id {items.schema['item_id'].dataType.simpleString()}")
        part = scratch.write(texts.mapInArrow(
            _searcher(sent), f"doc_id {kind}, text_hash bigint, k bigint, score double, end_word bigint"), "matches").join(ids, "k").drop("k")
        found = part if found is None else found.union(part)
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, item_id, score, end_word`` for each contaminated document and
    the item; ``score`` is the share of a whole copy's, ``end_word`` where the
    best alignment ends in the document."""
    found = matches(docs, benchmark, block_words)
    if found is None:
        return docs.where(F.lit(False)).select(
            "doc_id", F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("end_word"))
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "end_word")).alias("best")).select("doc_id", "item_id", "best.*")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that hold no passage of a test item. Each row is decided by its
    own text: others under its id, or with a null id too, do not matter."""
    found = matches(docs, read_table(spark, sf_dir, "benchmark"))
    if found is None:
        return docs
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(docs["text"].cast("string")) == found["_hash"]), "left_anti")
