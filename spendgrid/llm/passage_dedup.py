"""Substring dedup: near-equal paragraphs and repeated passages.

**Paragraphs.** A paragraph is a line of ``min_words`` words or more; equal
ones (A-Z lower-cased, by words) are one node. A node is put into inverted
lists under MinHash bands over its ``SHINGLE``-word shingles; :func:`tuned`
chooses bands and rows from the wanted recall at the similarity asked for.
Paragraphs that meet in a list are checked by the exact Jaccard similarity of
their shingles; connected components make classes, of which all but the first
place, in the order of (doc_id, line), are removed.

**Passages.** Runs of ``min_words`` words that stand in several texts, wherever
line ends fall:

1. The words of a whole text are winnowed: of the hashes of ``SEED`` words that
   lie in a window of ``min_words`` words, the least is a seed. Two equal
   windows have equal seeds, so no repeated run lacks a shared one.
2. Texts with shared seeds give the hashes of their windows over such seeds.
3. The first text, in the order of doc_id, that holds a window keeps it; it is
   removed from all others. Windows that follow each other and come from the
   same first text are one passage.

Texts that are equal as a whole are one node throughout: the first document
keeps the text, a passage that covers all of it is removed from the others.

Words and runs are compared by 64-bit hashes. Defined cases: null texts and
texts of fewer words hold nothing; rows of equal id and text are one document;
null ids come first; runs that are repeated within one text alone are left;
further columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid.llm.common import (_BASE, _BASE_INVERSE, Scratch, _powers, filtered_scans, hash_grams, hash_spans, hash_words, mix,
                                  read_table, shingle_set, text_bytes, text_of, word_spans)
from spendgrid.llm.lists import classes, dealt_by_group, distinct_lists, pairs_within, shared_entries, whole_groups
from spendgrid.llm.near_duplicates import _slices
from spendgrid.operators.joins import dimension_join

MIN_WORDS = 50
SHINGLE = 5
SEED = 20
PERCENT = 80
RECALL = 0.999
MOST_HASHES = 30
BATCH_BYTES = 8 << 20


def tuned(similarity: float, recall: float, most: int) -> tuple[int, int]:
    """(bands, rows) with the most rows, so the fewest chance meetings, by which
    a pair of that similarity meets with probability ``recall``, out of
    ``most`` hashes; one row if none are few enough."""
    found = None
    for rows in range(1, most + 1):
        bands = ceil(log(1 - recall) / log(1 - similarity ** rows))
        if found is None or bands * rows <= most:
            found = bands, rows
    return found


BANDS, ROWS = tuned(PERCENT / 100, RECALL, MOST_HASHES)
_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def runs_of(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all windows of n words, by one running sum."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    powers, inverse = _powers(_BASE, len(words) + 1), _powers(_BASE_INVERSE, len(words) + 1)
    running = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers[:len(words)], out=running[1:])
    return mix((running[n:] - running[:size]) * inverse[:size])


def nodes_of(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64 bits of each of the word sequences ``words[first[i]:first[i + 1]]``."""
    powers, inverse = _powers(_BASE, len(words) + 1), _powers(_BASE_INVERSE, len(words) + 1)
    running = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers[:len(words)], out=running[1:])
    return mix((running[first[1:]] - running[first[:-1]]) * inverse[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def band_keys(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``BANDS`` keys, a row for each of the paragraphs, which are
    ``words[first[i]:first[i + 1]]`` and of ``SHINGLE`` words at least."""
    n = len(first) - 1
    keys = np.zeros((n, BANDS), dtype=np.uint64)
    if not n:
        return keys
    grams = hash_grams(words, SHINGLE)
    cut = np.ravel(np.column_stack((first[:-1], first[1:] - SHINGLE + 1)))
    cut = cut[:-1] if cut[-1] >= len(grams) else cut
    for band in range(BANDS):
        key = np.full(n, np.uint64(band + 1), dtype=np.uint64)
        for row in range(ROWS):
            least = np.minimum.reduceat(mix(grams ^ _SEEDS[band * ROWS + row]), cut)[::2]
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
        keys[:, band] = key
    return keys


def windows(words: np.ndarray, first: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of ``min_words`` words of the texts ``words[first[i]:first[i + 1]]``:
    (place of the first word in ``words``, text, place of the seed) and the
    seeds' hashes by place."""
    size = np.diff(first)
    text = np.repeat(np.arange(len(size)), size)
    seed = min(SEED, min_words)
    hashes = runs_of(words, seed)
    reach = min_words - seed + 1  # seeds within a window
    least = np.arange(len(hashes))
    width = 1
    while width < reach:  # the place of the least hash among ``width`` that follow
        step = min(width, reach - width)
        a, b = least[:-step], least[step:]
        least = np.where(hashes[a] <= hashes[b], a, b)
        width += step
    at = np.arange(len(least))
    at = at[at + min_words <= first[1:][text[at]]]
    return at, text[at], least[at], hashes


class Batch:
    """Words of the texts of an Arrow column, and its paragraphs."""

    def __init__(self, column: pa.Array, min_words: int):
        data, offsets = text_bytes(column)
        start, end = word_spans(data)
        self.words = hash_spans(data, start, end, True)
        self.first = np.searchsorted(start, offsets)
        ends = np.flatnonzero(data == 10)  # each text has one more newline
        stop = np.searchsorted(start, ends)
        begin = np.append(0, stop[:-1])
        long = np.flatnonzero(stop - begin >= min_words)
        self.begin, self.stop = begin[long], stop[long]
        self.row = np.searchsorted(offsets, ends[long], side="right") - 1
        self.line = long - np.searchsorted(ends, offsets)[self.row]

    def paragraphs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, first, node) of the paragraphs alone."""
        size = self.stop - self.begin
        first = np.append(0, np.cumsum(size))
        words = self.words[np.repeat(self.begin - first[:-1], size) + np.arange(first[-1])]
        return words, first, nodes_of(words, first)


def _entries(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bands of paragraphs under odd keys, seeds of whole texts under even."""
    for batch in _slices(batches, rows=1 << 14, size=BATCH_BYTES):
        read = Batch(batch.column(0), min_words)
        words, first, node = read.paragraphs()
        bands = band_keys(words, first)
        at, _, seed, hashes = windows(read.words, read.first, min_words)
        seed = np.unique(seed)
        text = np.searchsorted(read.first, seed, side="right") - 1
        one = np.uint64(1)
        yield (np.concatenate([bands.ravel() | one, hashes[seed] & ~one]),
               np.concatenate([np.repeat(node, BANDS), batch.column(1).to_numpy()[text]]))


def _places(min_words: int):
    """Paragraphs, and under line -1 the texts of ``min_words`` or more."""
    def run(batches):
        for batch in _slices(batches, rows=1 << 14, size=BATCH_BYTES):
            read = Batch(batch.column(2), min_words)
            whole = np.flatnonzero(np.diff(read.first) >= min_words)
            row = np.append(read.row, whole)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(at), batch.column(1).take(at), pa.array(np.append(read.line, np.full(len(whole), -1))),
                pa.array(np.append(read.paragraphs()[2], batch.column(1).to_numpy()[whole])),
                pa.array(np.append(read.begin, read.first[whole]) - read.first[row]),
                pa.array(np.append(read.stop - read.begin, np.diff(read.first)[whole]))],
                names=["doc_id", "text_hash", "line", "node", "start", "n"])
    return run


def _new_places(batches: Iterator[pa.RecordBatch], read: set) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        new = []
        for place in batch.column(0).to_pylist():
            new.append(place not in read)
            read.add(place)
        yield batch if all(new) else batch.filter(pa.array(new))


def _windows_over(min_words: int):
    """The windows whose seed is one of those asked for in the batch. Rows of
    equal id and text meet in a task, which reads one of them."""
    def run(batches):
        read = set()
        for batch in _new_places(batches, read):
            yield from over(batch)

    def over(whole):
        for batch in _slices([whole], rows=1 << 12, size=BATCH_BYTES):
            words, first = hash_words(batch.column(1))
            at, text, seed, hashes = windows(words, first, min_words)
            asked = np.unique(batch.column(2).flatten().to_numpy().view(np.uint64))
            hit = np.isin(hashes[seed] & ~np.uint64(1), asked)
            at, text = at[hit], text[hit]
            yield pa.RecordBatch.from_arrays([
                pa.array(runs_of(words, min_words)[at].view(np.int64)), batch.column(0).take(pa.array(text)),
                pa.array(at - first[text])], names=["value", "place", "start"])
    return run


# --- exact checks of paragraphs --------------------------------------------------------

def alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Two sorted sets of shingles are similar enough."""
    if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def _check(batches):
    for batch in _slices(batches, rows=4096):
        (ha, fa), (hb, fb) = hash_words(batch.column("text_a")), hash_words(batch.column("text_b"))
        keep = [alike(shingle_set(ha[fa[k]:fa[k + 1]], SHINGLE), shingle_set(hb[fb[k]:fb[k + 1]], SHINGLE))
                for k in range(batch.num_rows)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _compare(batches):
    """Links between components within two blocks of a list."""
    for table, cuts in whole_groups(batches, ["value", "i", "j"]):
        node, comp = (table.column(c).to_numpy() for c in ("node", "comp"))
        _, at, own = np.unique(node, return_index=True, return_inverse=True)
        hashes, first = hash_words(table.column("body").take(pa.array(at)).combine_chunks())
        sets = [shingle_set(hashes[x:y], SHINGLE) for x, y in zip(first[:-1], first[1:])]
        size = np.array([len(x) for x in sets])[own]
        root = {c: c for c in comp.tolist()}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        found = []
        for x, y in pairs_within(cuts):
            near = (comp[x] != comp[y]) & (100 * np.minimum(size[x], size[y]) >= PERCENT * np.maximum(size[x], size[y]))
            for a, b in zip(x[near].tolist(), y[near].tolist()):
                p, q = find(int(comp[a])), find(int(comp[b]))
                if p != q and alike(sets[own[a]], sets[own[b]]):
                    root[p] = q
                    found.append((int(node[a]), int(node[b])))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


# --- the job --------------------------------------------------------------------------

def _hot(table: DataFrame, key: str, share: float = 0.002, least: int = 1000) -> list:
    """The keys that hold ``share`` of the rows of a written table, so at most
    one for each share."""
    most = max(least, share * table.count())
    return [r[0] for r in table.groupBy(key).count().where(F.col("count") >= most).collect()]


def _near_paragraphs(texts: DataFrame, places: DataFrame, entries: DataFrame, scratch: Scratch) -> DataFrame:
    """Places of paragraphs that are similar to others, as in the result."""
    members = distinct_lists(scratch.write(entries, "bands"), scratch)
    place = places.where("line >= 0").join(members.select("node").distinct(), "node").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash", "line")).alias("p"))
    asked = scratch.write(place.groupBy(F.col("p.doc_id").alias("at_doc"), F.col("p.text_hash").alias("at_hash")).agg(
        F.collect_list(F.struct("node", "p.line")).alias("asked")), "asked")
    some = asked.where(F.size("asked") > 0)
    read = texts.join(some, texts["doc_id"].eqNullSafe(some["at_doc"]) & (texts["text_hash"] == some["at_hash"])).select(
        F.split("text", "\n").alias("l"), F.explode("asked").alias("q"))
    with filtered_scans(texts.sparkSession):
        body = scratch.write(read.select(F.col("q.node").alias("node"), F.get("l", F.col("q.line").cast("int")).alias("body")).dropDuplicates(["node"]), "bodies")

    def check(pairs: DataFrame, name: str) -> DataFrame:
        side = lambda s: body.select(F.col("node").alias(s), F.col("body").alias(f"text_{s}"))
        return scratch.write(pairs.join(side("a"), "a").join(side("b"), "b").select(
            "a", "b", "text_a", "text_b").mapInArrow(_check, "a bigint, b bigint"), name)

    def compare(dealt: DataFrame) -> DataFrame:
        return dealt_by_group(dealt.join(body, "node")).mapInArrow(_compare, "a bigint, b bigint")

    roots = classes(members, scratch, check, compare, block=512)
    scratch.drop(members, asked, body)
    found = scratch.write(places.where("line >= 0").join(roots, "node").withColumnRenamed("root", "class"), "near-places")
    firsts = found.groupBy("class").agg(F.min(F.struct("doc_id", "text_hash", "line", "start")).alias("first"))
    return dimension_join(found, firsts, "class", hot=_hot(found, "class")).select(
        "doc_id", "text_hash", "start", (F.col("start") + F.col("n")).alias("end"), F.col("first.doc_id").alias("class_id"),
        F.col("first.start").alias("class_start"), (F.struct("doc_id", "text_hash", "line", "start") != F.col("first")).alias("removed"))


def _passages(texts: DataFrame, places: DataFrame, entries: DataFrame, scratch: Scratch, min_words: int) -> DataFrame:
    """Passages of first documents of texts, as in the result."""
    seeds = entries.withColumnRenamed("node", "text_hash").groupBy("text_hash").agg(F.collect_list("value").alias("seeds"))
    first = places.where("line < 0").groupBy("text_hash").agg(F.min(F.struct("doc_id")).alias("p")).select("text_hash", "p.doc_id")
    # numbers that grow with (doc_id, text_hash) stand for texts from here on
    asked = scratch.write(seeds.join(first, "text_hash").orderBy(F.col("doc_id").asc_nulls_first(), "text_hash").select(
        F.monotonically_increasing_id().alias("place"), F.col("doc_id").alias("at_doc"), F.col("text_hash").alias("at_hash"), "seeds"), "asked")
    some = asked.where(F.size("seeds") > 0)
    read = texts.join(some, texts["doc_id"].eqNullSafe(some["at_doc"]) & (texts["text_hash"] == some["at_hash"])).select("place", "text", "seeds")
    with filtered_scans(texts.sparkSession):
        runs = scratch.write(read.mapInArrow(_windows_over(min_words), "value bigint, place bigint, start bigint"), "runs")
    about = scratch.write(runs.groupBy("value").agg(F.min("place").alias("origin"), F.max("place").alias("last")).where("origin < last").drop("last"), "about")
    number = F.expr("dense_rank() over (partition by place, origin order by start)")
    shared = scratch.write(dimension_join(runs, about, "value", hot=_hot(runs, "value")).where("origin is not null").withColumn(
        "island", F.col("start") - number), "shared-runs")
    scratch.drop(runs, about)
    passages = scratch.write(shared.groupBy("place", "origin", "island").agg(
        F.min_by("value", "start").alias("value"), F.min("start").alias("start"), (F.max("start") + F.lit(min_words)).alias("end")), "passages")
    # each passage belongs to that of its first text which holds its first window
    there = shared.where("place = origin").join(passages.select("value").distinct(), "value", "left_semi").groupBy("value", "origin").agg(
        F.min_by("island", "start").alias("there"))
    kept = passages.where("place = origin").select("origin", F.col("island").alias("there"), F.col("start").alias("class_start"))
    home = asked.select(F.col("place").alias("origin"), F.col("at_doc").alias("class_id"))
    first = scratch.write(there.join(kept, ["origin", "there"]).join(home, "origin").select("value", "class_id", "class_start"), "first")
    scratch.drop(shared)
    named = dimension_join(passages, first, "value", hot=_hot(passages, "value"))
    at = asked.select("place", F.col("at_doc").alias("doc_id"), F.col("at_hash").alias("text_hash"))
    return named.join(at, "place").select(
        "doc_id", "text_hash", "start", "end", "class_id", "class_start", (F.col("place") != F.col("origin")).alias("removed"))


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_hash, start_word, end_word, class_id, class_start,
    removed`` for each place of a paragraph or passage that stands in several
    places; words are counted from 0 over the whole text. ``class_id`` is the
    document of the first place, which stays. A place within another one of its
    document that is removed too, or stays too, has no row of its own."""
    scratch = Scratch(docs.sparkSession, "passage-dedup")
    texts = docs.select("doc_id", text_of().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    places = scratch.write(texts.select("doc_id", "text_hash", "text").mapInArrow(
        _places(min_words), f"doc_id {kind}, text_hash bigint, line bigint, node bigint, start bigint, n bigint").distinct(), "places")
    n_entries = places.agg(F.sum(F.when(F.col("line") < 0, 2 * F.col("n") / (min_words - SEED + 2)).otherwise(BANDS))).first()[0] or 0
    entries = shared_entries(texts.select("text", "text_hash"), lambda b: _entries(b, min_words), int(n_entries), scratch)

    near = _near_paragraphs(texts, places, entries.where("value & 1 = 1"), scratch)
    runs = _passages(texts, places, entries.where("value & 1 = 0"), scratch, min_words)
    whole = places.where("line < 0")
    copies = whole.groupBy("text_hash").agg(F.min(F.struct("doc_id")).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    equal = whole.join(copies, "text_hash").select(
        "doc_id", "text_hash", "start", F.col("n").alias("end"), F.col("first.doc_id").alias("class_id"), F.lit(0).cast("long").alias("class_start"),
        (~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).alias("removed"))
    found = scratch.write(near.unionByName(runs).unionByName(equal).withColumn("mark", F.xxhash64("class_id", "class_start")), "found")
    scratch.drop(places, entries)
    size = F.col("end") - F.col("start")
    wider = found.select(*(F.col(c).alias(f"{c}_") for c in ("doc_id", "text_hash", "start", "end", "removed", "mark")))
    same = (found["doc_id"].eqNullSafe(wider["doc_id_"]) & (found["text_hash"] == wider["text_hash_"]) & (found["removed"] == wider["removed_"])
            & (wider["start_"] <= found["start"]) & (wider["end_"] >= found["end"])
            & ((F.col("end_") - F.col("start_") > size) | (F.col("mark_") < F.col("mark"))))
    return found.join(wider, same, "left_anti").select(
        "doc_id", "text_hash", F.col("start").alias("start_word"), F.col("end").alias("end_word"), "class_id", "class_start", "removed").distinct()


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _without(text: str, drops: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``drops``; a line that loses words has
    single spaces, and goes if none is left."""
    out, at = [], 0
    gone = np.zeros(sum(1 for _ in _WORD.finditer(text)), dtype=bool)
    for start, end in drops:
        gone[start:end] = True
    for line in text.split("\n"):
        words = _WORD.findall(line)
        lost = gone[at:at + len(words)]
        at += len(words)
        if not lost.any():
            out.append(line)
        elif not lost.all():
            out.append(" ".join(w for w, g in zip(words, lost) if not g))
    return "\n".join(out)


def _cut(batches):
    for batch in batches:
        texts = [t if d is None else _without(t, [(x["start_word"], x["end_word"]) for x in d])
                 for t, d in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "left"])


def remove_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, without the words of removed places."""
    found = repeated_passages(docs, min_words).where("removed")
    drops = found.groupBy(F.col("doc_id").alias("drop_doc"), F.col("text_hash").alias("drop_hash")).agg(
        F.collect_list(F.struct("start_word", "end_word")).alias("drops"))
    keyed = docs.select(F.struct("*").alias("row"), text_of().alias("text_"))
    joined = keyed.join(drops, F.col("row.doc_id").eqNullSafe(F.col("drop_doc")) & (F.xxhash64("text_") == F.col("drop_hash")), "left").select("row", "text_", "drops")
    row = joined.schema["row"].dataType.simpleString()
    whole = joined.where("drops is null").select("row.*")
    cut = joined.where("drops is not null").mapInArrow(_cut, f"row {row}, left string")
    return whole.unionByName(cut.select(F.col("row").withField("text", F.col("left")).alias("row")).select("row.*"))


def op8_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents")).drop("text_hash")
