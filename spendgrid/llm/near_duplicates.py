"""Near-duplicate documents by bottom-k sketches of one hash function.

1. Rows with equal shingle sets are one node. A node keeps the ``SKETCH``
   least shingle hashes, which are a random sample of its set.
2. Inverted lists of retained values: of its ``INDEXED`` least values a node
   enters the rarest, as many that two nodes of the wanted similarity share an
   entry unless a binomial tail under ``MISS`` strikes (prefix filter on the
   sketches). Values of passages that very many documents share are thereby
   left out of the lists of all nodes that are not mostly such passages.
3. Each list links its members to its least node only (a star, no pairs).
   Union sketches estimate the similarity and drop what is far below; exact
   Jaccard similarity on the full sets decides.
4. Members of a list that are still in different components are compared in
   blocks of ``BLOCK`` members (of ``BLOCK_SHINGLES`` shingles, if that is
   less), on their full sets, each pair in one list; only
   links that join components leave the task. So every pair that shares an
   entry is connected, or was compared.
5. Components over the exact links.

Shingles are compared by 64-bit hashes. Defined cases: a document without
words, or a null text, has an empty set and is linked with nothing; with fewer
words than a shingle has, the whole sequence is the one shingle; rows of equal
id are nodes by their texts, which are found again by id and a 64-bit hash of
the text; rows with a null id take part, and their component is the least id
that is not null; further columns do not matter; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid.llm.common import Scratch, hash_words, read_table, shingle_set, text_key
from spendgrid.llm.components import connected_components
from spendgrid.llm.lists import blocks_of

SKETCH = 64
INDEXED = 32
MISS = 1e-7
BLOCK, BLOCK_SHINGLES = 2048, 2_000_000
BATCH_ROWS = 512


def safe_overlap(k: int, percent: int) -> int:
    """The largest m for which fewer than m of k samples hit, each with
    probability percent / 100, is less likely than ``MISS``."""
    p, tail, m = percent / 100, 0.0, 0
    while m < k:
        tail += comb(k, m) * p**m * (1 - p) ** (k - m)
        if tail > MISS:
            break
        m += 1
    return m


def _sets(column: pa.Array, words: int) -> list[np.ndarray]:
    hashes, first = hash_words(column)
    return [shingle_set(hashes[a:b], words) for a, b in zip(first[:-1], first[1:])]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total = np.zeros(batch.num_rows, dtype=np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type):
                total += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(total), 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right"))
            stop = max(at + 1, min(stop, at + rows))
            yield batch.slice(at, stop - at)
            at = stop


def _sketcher(words: int):
    def run(batches):
        for batch in _slices(batches):
            sets = _sets(batch.column(1), words)
            keys = [int.from_bytes(blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()),
                pa.array([s[:SKETCH].tobytes() for s in sets], pa.binary())], names=["doc_id", "text_hash", "n", "node", "sketch"])
    return run


def _indexer(batches):
    for batch in batches:
        values = [np.frombuffer(s, np.int64)[:INDEXED] for s in batch.column("sketch").to_pylist()]
        size = np.array([len(v) for v in values], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([np.zeros(0, np.int64), *values])),
            pa.array(np.repeat(batch.column("node").to_numpy(), size)), pa.array(np.repeat(batch.column("n").to_numpy(), size))],
            names=["value", "node", "n"])


def _padded(sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    out = np.full((len(sketches), SKETCH), np.iinfo(np.uint64).max, dtype=np.uint64)
    size = np.array([len(s) // 8 for s in sketches], dtype=np.int64)
    if len(sketches):
        out[np.arange(SKETCH) < size[:, None]] = np.frombuffer(b"".join(sketches), np.uint64)
    return out, size


def _estimate(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of padded sketches may reach the similarity: among the least
    values of the union, how many are in both."""
    if not len(a):
        return np.zeros(0, dtype=bool)
    none = np.iinfo(np.uint64).max
    merged = np.sort(np.concatenate((a, b), axis=1), axis=1)
    real = merged != none
    twice = np.zeros(merged.shape, dtype=bool)
    twice[:, :-1] = (merged[:, :-1] == merged[:, 1:]) & real[:, :-1]
    distinct = real.copy()
    distinct[:, 1:] &= merged[:, 1:] != merged[:, :-1]
    rank = np.cumsum(distinct, axis=1)
    union = rank[:, -1]
    both = (twice & (rank <= SKETCH)).sum(axis=1)
    whole = union < SKETCH  # both sketches are the full sets
    return np.where(whole, 100 * both >= percent * union, both >= safe_overlap(SKETCH, percent))


def _size_fits(a, b, percent: int):
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def _pair_filter(percent: int):
    def run(batches):
        for batch in _slices(batches, rows=1 << 13):
            a, _ = _padded(batch.column("sketch_a").to_pylist())
            b, _ = _padded(batch.column("sketch_b").to_pylist())
            keep = pa.array(_estimate(a, b, percent))
            yield batch.select(["a", "b"]).filter(keep)
    return run


def _verifier(words: int, percent: int):
    def run(batches):
        for batch in _slices(batches):
            sets_a, sets_b = _sets(batch.column("text_a"), words), _sets(batch.column("text_b"), words)
            keep = []
            for x, y in zip(sets_a, sets_b):
                union = len(np.union1d(x, y))
                keep.append(100 * (len(x) + len(y) - union) >= percent * union)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _block_links(words: int, percent: int):
    """Links between different components among the rows of two blocks of a
    list, as a spanning forest. A pair is looked at in the least of the lists
    that both are in. Overlaps of the full sets are counted for all pairs at
    once, by a product of 0/1 matrices over the shingles, some at a time."""
    def run(key, group):
        table = group.combine_chunks()
        value, i, j = (k.as_py() for k in key)
        node, n, comp, side = (table.column(c).to_numpy() for c in ("node", "n", "comp", "block"))
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        maybe = comp[left][:, None] != comp[right][None, :]
        maybe &= 100 * np.minimum.outer(n[left], n[right]) >= percent * np.maximum.outer(n[left], n[right])
        if i == j:
            maybe &= node[left][:, None] < node[right][None, :]
        values = [np.array([x for x in v if x < value], dtype=np.int64) for v in table.column("values").to_pylist()]
        maybe &= _overlap(values, left, right) == 0
        keep_left, keep_right = maybe.any(axis=1), maybe.any(axis=0)
        left, right, maybe = left[keep_left], right[keep_right], maybe[keep_left][:, keep_right]
        if not maybe.any():
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        used = np.unique(np.concatenate((left, right)))
        sets: list = [np.zeros(0, np.uint64)] * len(node)
        for k, found in zip(used, _sets(table.column("text").take(pa.array(used)).combine_chunks(), words)):
            sets[k] = found
        both = _overlap(sets, left, right)
        union = np.add.outer(n[left], n[right]) - both
        x, y = np.nonzero(maybe & (100 * both >= percent * union))
        root = {c: c for c in comp.tolist()}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        links = []
        for a, b in zip(left[x].tolist(), right[y].tolist()):
            p, q = find(int(comp[a])), find(int(comp[b]))
            if p != q:
                root[p] = q
                links.append((min(node[a], node[b]), max(node[a], node[b])))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})
    return run


def _overlap(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with those ``right``."""
    used = np.unique(np.concatenate((left, right)))
    size = np.array([len(sets[k]) for k in used])
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    if not size.sum():
        return out
    _, inverse, count = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(used)), size)
    shared = count[inverse] > 1
    row, column = row[shared], (np.cumsum(count > 1) - 1)[inverse[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    l, r = np.searchsorted(used, left), np.searchsorted(used, right)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        lo, hi = np.searchsorted(column, (begin, begin + columns))
        held = np.zeros((len(used), columns), dtype=np.float32)
        held[row[lo:hi], column[lo:hi] - begin] = 1
        out += (held[l] @ held[r].T).astype(np.int64)
    return out


def components_of_rows(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, text_hash, n, node, root, component_id`` for each row of
    ``docs`` (``doc_id`` bigint, ``text``): rows of one ``root`` are a component
    over all links of at least ``percent`` per cent Jaccard similarity of the
    ``words``-word shingles; node and root are null without any shingle."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-duplicates")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), text_key().alias("text_hash"))
    sketched = scratch.write(texts.mapInArrow(
        _sketcher(words), "doc_id bigint, text_hash bigint, n bigint, node bigint, sketch binary"), "sketched")
    nodes = scratch.write(sketched.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("id"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("at"),
        F.first("n").alias("n"), F.first("sketch").alias("sketch")), "nodes")
    rows = scratch.write(sketched.select("doc_id", "text_hash", "n", "node"), "rows")
    scratch.drop(sketched)

    # inverted lists
    entries = nodes.select("node", "n", "sketch").mapInArrow(_indexer, "value bigint, node bigint, n bigint")
    shared = entries.groupBy("value").agg(F.count("*").alias("freq")).where("freq > 1")
    held = F.least(F.col("n"), F.lit(INDEXED))
    need = F.when(F.col("n") * 100 <= INDEXED * percent, F.ceil(F.col("n") * percent / 100)).otherwise(safe_overlap(INDEXED, percent))
    ranked = entries.join(shared, "value").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("freq", "value"))).alias("e"))
    lists = scratch.write(ranked.select("node", "n", F.explode(F.slice(
        "e", F.lit(1), F.greatest(F.lit(0), (held - need + 1 - (held - F.size("e"))).cast("int")))).alias("e")).select(
        F.col("e.value").alias("value"), "node", "n"), "lists")
    # lists with the same members say the same: one of them is enough
    about = lists.groupBy("value").agg(
        F.count("*").alias("size"), F.min("node").alias("center"), F.sum("n").alias("total"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark"))
    about = scratch.write(about.where("size > 1").groupBy("size", "total", "center", "mark").agg(F.min("value").alias("value")), "about")
    members = scratch.write(lists.join(about, "value").select("value", "size", "total", "center", "node", "n"), "members")
    scratch.drop(lists)

    # what the comparisons need of the nodes that are in any list
    listed = members.select("node").distinct()
    active = scratch.write(nodes.join(listed, "node", "left_semi"), "active")
    at = active.select(F.col("at.doc_id").alias("at_doc"), F.col("at.text_hash").alias("at_hash"), "node")
    body = scratch.write(texts.join(at, texts["doc_id"].eqNullSafe(at["at_doc"]) & (texts["text_hash"] == at["at_hash"])).select(
        "node", "text").dropDuplicates(["node"]), "texts")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        side = lambda s: body.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}"))
        return scratch.write(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(
            _verifier(words, percent), "a bigint, b bigint"), name)

    # stars
    stars = members.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    side = lambda s: active.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    likely = scratch.write(stars.join(side("a"), "a").join(side("b"), "b").where(_size_fits("n_a", "n_b", percent)).select(
        "a", "b", "sketch_a", "sketch_b").mapInArrow(_pair_filter(percent), "a bigint, b bigint"), "likely")
    links = verified(likely, "star-links")
    first = connected_components(links, scratch)

    # members of a list that no star has brought together
    placed = members.where("size > 2").join(first, "node", "left").select(
        "value", "size", "total", "node", "n", F.coalesce("root", "node").alias("comp"))
    open_lists = placed.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("value")
    values = members.groupBy("node").agg(F.collect_list("value").alias("values"))
    wanted = scratch.write(placed.join(open_lists, "value", "left_semi").join(values, "node"), "open")
    n_blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("total") / BLOCK_SHINGLES))
    more = blocks_of(wanted, n_blocks).drop("total").join(body, "node").groupBy("value", "i", "j").applyInArrow(
        _block_links(words, percent), "a bigint, b bigint")
    links = links.union(scratch.write(more, "block-links"))
    found = connected_components(links, scratch)
    scratch.drop(members, about, active, body, likely, wanted)  # the components are written

    # the least id of each component
    linked = nodes.select("node", "id").join(found.select("node", "root").union(found.select("root", "root")).distinct(), "node")
    least = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    named = linked.select("node", "root").join(least, "root").select("node", "root", "component_id")
    classes = nodes.select("node", "id").join(named, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.coalesce("component_id", "id").alias("component_id"))
    return rows.join(classes, "node", "left").select(
        "doc_id", "text_hash", "n", "node", "root", F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``."""
    return components_of_rows(docs, words, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), words=4, percent=80)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component, with five-word shingles: the one of the least
    id, null last, and of the least hash of its text. Rows without words are
    components of their own. Rows are told apart by id and text: unrelated texts
    under one id all stay, and of rows equal in both one stays, unless they have
    neither id nor words."""
    rows = components_of_rows(docs)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    first = rows.where("node is not null").groupBy("root").agg(F.min(place).alias("at")).select("at.doc_id", "at.text_hash")
    kept = Scratch(spark, "near-duplicate-stage").write(first.union(rows.where("node is null").select("doc_id", "text_hash")).distinct(), "left")
    staying = docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]) & (F.xxhash64(docs["text"].cast("string")) == kept["text_hash"]), "left_semi")
    if not docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        return staying
    worded = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = staying.where(F.col("doc_id").isNotNull() | worded).select(F.struct("*").alias("row"), "doc_id", text_key().alias("text_hash"))
    return keyed.dropDuplicates(["doc_id", "text_hash"]).select("row.*").union(staying.where(F.col("doc_id").isNull() & ~worded))
