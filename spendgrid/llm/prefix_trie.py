"""Trie over the turns of rebuilt conversations.

A rebuilt conversation begins with the first ``h`` turns of another one, and
goes on with its own after its first ``h``; a node stands for each distinct
sequence of first turns. The method:

1. A turn becomes 128 bits of (position, role, text). The digest of a prefix is
   the exclusive or of its turns' bits, so it needs no turn-by-turn chain: a
   long conversation is cut into blocks, each of which runs by itself.
2. Every task counts the digests of its rows in a count-min sketch of two rows
   of ``CELLS`` cells that stop at two; sketches are merged chunk by chunk. The
   cells that reached two are sent out: two bits for each of ``CELLS``, 4 MiB
   whatever the input.
3. A digest with a cell that did not reach two has an estimate of one, which a
   count-min sketch never gives too low: its prefix is in one conversation.
   Such nodes (tails) are complete where they are and are emitted there.
4. Prefixes that may be shared are grouped exactly by all 128 bits. Sums over
   subtrees are sums over a node's members: a node's savings are booked on its
   smallest member, a leaf on its own, and summed along that conversation from
   its end. No step follows the trie level by level.

On a corpus far above ``CELLS`` prefixes the sketch proves less and more rows
take part in the grouping; the result is the same.

Hot groups: nodes are counted by partial aggregation, joins on nodes are left
to Spark's splitting of skewed partitions, and a conversation of very many
turns is dealt to blocks of ``BLOCK`` turn numbers. The ids of a node's ending
members are packed to text in range-dealt tasks; SHA-256 of a node is one
chain by definition and reads that text as a stream.

Defined cases: null turns come first; rows of equal turn are ordered by a hash
of role and text; repeated rows are turns of their own; null role or text is
empty; rows with a null ``conv_id`` are in no conversation; other columns do
not matter; an empty table gives no rows (no root either). Turns of equal
number in one conversation stay in one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendgrid.llm.common import Scratch, mix, read_table

GROUP = 100      # a conversation borrows from the first of its hundred
HEADS = 6        # and less than six turns
CELLS = 1 << 24
CHUNK = 1 << 19  # cells
BLOCK = 4096
TEXT_BYTES = 1 << 16
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def borrowed_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("long")


# --- rebuilt conversations and their prefix digests -----------------------------

def _terms(depth: Column) -> list[Column]:
    return [F.xxhash64(depth, "h1", "h2").alias("t1"), F.xxhash64("h2", depth, "h1").alias("t2")]


def _carried(rows: DataFrame, scratch: Scratch, sums: dict[str, Column], backwards: bool = False) -> DataFrame:
    """Running totals along each conversation. ``rows`` has ``c``, ``block`` and
    ``d``, blocks in the order of ``d``; ``sums`` gives, by column, what makes
    up its total from the column itself (a sum or an exclusive or)."""
    d = F.col("d").desc() if backwards else F.col("d")
    block = F.col("block").desc() if backwards else F.col("block")
    within = Window.partitionBy("c", "block").orderBy(d).rowsBetween(Window.unboundedPreceding, 0)
    others = [x for x in rows.columns if x not in sums]
    local = scratch.write(rows.select(*others, *[total.over(within).alias(x) for x, total in sums.items()],
                                      *[F.col(x).alias(f"own_{x}") for x in sums]), "running")
    blocks = local.select("c", "block", *[F.col(f"own_{x}").alias(x) for x in sums]).groupBy("c", "block").agg(
        *[total.alias(x) for x, total in sums.items()])
    before = Window.partitionBy("c").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    earlier = blocks.select("c", "block", F.count("*").over(Window.partitionBy("c")).alias("blocks"),
                            *[total.over(before).alias(f"before_{x}") for x, total in sums.items()]).where("blocks > 1").drop("blocks")
    joined = local.join(earlier, ["c", "block"], "left")
    return joined.select(*others, *[F.expr(f"{x} ^ coalesce(before_{x}, 0)" if x.startswith("p") else f"{x} + coalesce(before_{x}, 0)").alias(x)
                                    for x in sums])


def rebuilt_prefixes(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``c, d, block, total, t1, t2, p1, p2, chars``: a row for each turn of each
    rebuilt conversation, with the digest of the prefix that it ends; one of
    depth 0 where no turn is left. ``p1 ^ t1`` is the digest of the prefix before."""
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hashed = rows.select(
        "c", F.floor(F.col("turn") / BLOCK).alias("block"), "turn", F.xxhash64("role", "text").alias("h1"),
        F.xxhash64("text", F.length("role"), "role").alias("h2"), F.length("text").cast("long").alias("chars"))
    within = Window.partitionBy("c", "block").orderBy(F.col("turn").asc_nulls_first(), "h1", "h2")
    placed = hashed.select("c", F.coalesce("block", F.lit(-(1 << 62))).alias("block"), "turn", "h1", "h2", "chars")
    own = scratch.write(placed.select("c", "block", F.row_number().over(within).cast("long").alias("at"), "h1", "h2", "chars"), "turns")
    blocks = own.groupBy("c", "block").agg(F.count("*").alias("n"))
    by_block = Window.partitionBy("c").orderBy("block")
    blocks = scratch.write(blocks.select(
        "c", "block", (F.sum("n").over(by_block) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("c")).alias("n")), "blocks")
    first_turns = own.where(f"c % {GROUP} = 0 and at < {HEADS}").join(blocks.where("before < 5").drop("n"), ["c", "block"]).withColumn(
        "at", F.col("at") + F.col("before")).where(f"at < {HEADS}")
    heads = first_turns.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("at", "h1", "h2", "chars"))).alias("head")).withColumnRenamed("c", "base")
    h = borrowed_turns(F.col("c"))
    known = blocks.withColumn("base", F.col("c") - F.col("c") % GROUP).join(heads, "base", "left").withColumn("h", h)
    known = known.withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<at:bigint,h1:bigint,h2:bigint,chars:bigint>>")), F.lit(1), F.col("h").cast("int")))
    known = scratch.write(known.select(
        "c", "block", "before", "h", "head", F.size("head").cast("long").alias("k"),
        (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("total")), "known")
    after = own.join(known.drop("head"), ["c", "block"]).withColumn("at", F.col("at") + F.col("before")).where("at > h").select(
        "c", (F.col("at") - F.col("h") + F.col("k")).alias("d"), "total", "h1", "h2", "chars")
    once = known.where("before = 0")  # a conversation's first block
    head = once.select("c", "total", F.explode("head").alias("x")).select("c", F.col("x.at").alias("d"), "total", "x.h1", "x.h2", "x.chars")
    both = after.unionByName(head).withColumn("block", F.floor(F.col("d") / BLOCK))
    terms = both.select("c", "d", "block", "total", "chars", *_terms(F.col("d")))
    run = _carried(terms.withColumns({"p1": F.col("t1"), "p2": F.col("t2")}), scratch,
                   {"p1": F.bit_xor("p1"), "p2": F.bit_xor("p2")})
    zero = F.lit(0).cast("long")
    bare = once.where("total = 0").select("c", zero.alias("d"), zero.alias("block"), "total", zero.alias("chars"),
                                          *[zero.alias(x) for x in ("t1", "t2", "p1", "p2")])
    return scratch.write(run.unionByName(bare), "prefixes")


# --- the sketch --------------------------------------------------------------------

def _cells(p1: np.ndarray, p2: np.ndarray, cells: int) -> list[np.ndarray]:
    """A digest's cell in each of the two rows of the sketch."""
    with np.errstate(over="ignore"):
        return [(mix(p.view(np.uint64) + np.uint64(k + 1)) % np.uint64(cells)).astype(np.int64) for k, p in enumerate((p1, p2))]


def _count(cells: int):
    """A task's own sketch, in chunks: bits of cells met, and met again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, cells), dtype=np.uint8)
        for batch in batches:
            digests = [np.ascontiguousarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in (0, 1)]
            for row, at in zip(counts, _cells(*digests, cells)):
                hit, n = np.unique(at, return_counts=True)
                row[hit] = np.minimum(row[hit] + np.minimum(n, 2), 2)
        size = min(CHUNK, cells)
        for row in range(2):
            for begin in range(0, cells, size):
                part = counts[row, begin:begin + size]
                if part.any():
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row * (cells // size) + begin // size], pa.int64()), pa.array([TaskContext.get().partitionId() % 16], pa.int64()),
                        pa.array([_squeezed(np.packbits(part >= 1))], pa.binary()), pa.array([_squeezed(np.packbits(part >= 2))], pa.binary())], names=["chunk", "salt", "met", "again"])
    return run


def _squeezed(data: np.ndarray) -> bytes:
    return pa.compress(data.tobytes(), codec="zstd", asbytes=True)


def _merge(cells: int):
    """The sketches of a chunk, one after the other."""
    size = min(CHUNK, cells) // 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, met, again = None, None, None

        def done():
            return pa.RecordBatch.from_arrays([
                pa.array([at], pa.int64()), pa.array([_squeezed(met)], pa.binary()), pa.array([_squeezed(again)], pa.binary())],
                names=["chunk", "met", "again"])

        for batch in batches:
            for chunk, more, twice in zip(*(c.to_pylist() for c in batch.columns)):
                if chunk != at:
                    if at is not None:
                        yield done()
                    at, met, again = chunk, np.zeros(size, np.uint8), np.zeros(size, np.uint8)
                more, twice = (np.frombuffer(pa.decompress(x, size, codec="zstd", asbytes=True), np.uint8) for x in (more, twice))
                again = again | twice | (met & more)
                met = met | more
        if at is not None:
            yield done()
    return run


def screen(rows: DataFrame, cells: int = CELLS) -> np.ndarray:
    """Bits of the cells that two or more of the rows met, by row of the sketch.
    They are merged in two steps, so no task reads the sketches of all others."""
    schema = "chunk bigint, met binary, again binary"
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = rows.select("p1", "p2").mapInArrow(_count(cells), "chunk bigint, salt bigint, met binary, again binary")
    dealt = own.repartition(tasks, "chunk", "salt").sortWithinPartitions("chunk").drop("salt").mapInArrow(_merge(cells), schema)
    merged = dealt.repartition(tasks, "chunk").sortWithinPartitions("chunk").mapInArrow(_merge(cells), schema).select("chunk", "again")
    size = min(CHUNK, cells)
    bits = np.zeros(2 * cells // 8, dtype=np.uint8)
    for r in merged.collect():  # at most 2 * cells bits
        bits[r["chunk"] * size // 8:(r["chunk"] + 1) * size // 8] = np.frombuffer(pa.decompress(r["again"], size // 8, codec="zstd", asbytes=True), np.uint8)
    return bits.reshape(2, -1)


def estimated(rows: DataFrame, bits: np.ndarray, cells: int) -> DataFrame:
    """``rows`` with ``shared`` and ``parent_shared``: false where the estimate
    of the prefix, and of the one before, is one. The root counts as shared."""
    sent = rows.sparkSession.sparkContext.broadcast(bits)
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = sent.value
        for batch in batches:
            x = {name: np.ascontiguousarray(batch.column(columns.index(name)).to_numpy(zero_copy_only=False)) for name in ("p1", "p2", "t1", "t2")}

            def several(p1, p2):
                out = np.ones(len(p1), dtype=bool)
                for row, at in zip(again, _cells(p1, p2, cells)):
                    out &= (row[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
                return out

            d = batch.column(columns.index("d")).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array((d == 0) | several(x["p1"], x["p2"])),
                pa.array((d <= 1) | several(x["p1"] ^ x["t1"], x["p2"] ^ x["t2"]))], names=[*columns, "shared", "parent_shared"])

    return rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", shared boolean, parent_shared boolean")


# --- ids of the conversations that end in a node --------------------------------------

def _written_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of a node as decimal text, up to ``TEXT_BYTES`` each."""
    key, first, parts, size = None, None, [], 0

    def done():
        return pa.RecordBatch.from_arrays([
            pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([first], pa.int64()),
            pa.array([",".join(parts)], pa.string())], names=["p1", "p2", "first", "ids"])

    for batch in batches:
        for p1, p2, c in zip(*(x.to_pylist() for x in batch.columns)):
            if (p1, p2) != key or size > TEXT_BYTES:
                if key is not None:
                    yield done()
                key, first, parts, size = (p1, p2), c, [], 0
            parts.append(str(c))
            size += len(parts[-1]) + 1
    if key is not None:
        yield done()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None

    def done():
        return pa.RecordBatch.from_arrays([
            pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([state.hexdigest()], pa.string())], names=["p1", "p2", "ends_sha256"])

    for batch in batches:
        for p1, p2, _, ids in zip(*(x.to_pylist() for x in batch.columns)):
            if (p1, p2) != key:
                if key is not None:
                    yield done()
                key, state = (p1, p2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if key is not None:
        yield done()


def end_digests(ends: DataFrame) -> DataFrame:
    """``p1, p2, ends_sha256`` of written rows ``p1, p2, c``."""
    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = ends.repartitionByRange(tasks, "p1", "p2", "c").sortWithinPartitions("p1", "p2", "c").mapInArrow(
        _written_ids, "p1 bigint, p2 bigint, first bigint, ids string")
    return texts.repartition(tasks, "p1", "p2").sortWithinPartitions("p1", "p2", "first").mapInArrow(
        _digested, "p1 bigint, p2 bigint, ends_sha256 string")


# --- the trie ----------------------------------------------------------------------------

def prefix_trie(turns: DataFrame, cells: int = CELLS) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` for every node."""
    scratch = Scratch(turns.sparkSession, "prefix-trie")
    prefixes = rebuilt_prefixes(turns, scratch)
    bits = screen(prefixes.where("d > 0"), cells)
    rows = scratch.write(estimated(prefixes, bits, cells).withColumns(
        {"q1": F.expr("p1 ^ t1"), "q2": F.expr("p2 ^ t2")}).drop("t1", "t2"), "estimated")
    scratch.drop(prefixes)
    tails = rows.where("not shared")
    maybe = rows.where("shared and d > 0")
    nodes = scratch.write(maybe.groupBy("p1", "p2", "d").agg(
        F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"),
        F.first("q1").alias("q1"), F.first("q2").alias("q2")), "nodes")
    # the top of a tail is a child of a node that may be shared
    children = nodes.select("q1", "q2").union(tails.where("parent_shared").select("q1", "q2"))
    n_children = children.groupBy("q1", "q2").agg(F.count("*").alias("n_children")).select(
        F.col("q1").alias("p1"), F.col("q2").alias("p2"), "n_children")
    nodes = scratch.write(nodes.join(n_children.where("p1 != 0 or p2 != 0"), ["p1", "p2"], "left").fillna(0, ["n_children"]), "with-children")

    # savings and leaves, booked on one member each and summed from its end
    least = F.col("c") == F.col("conv_id")
    booked = maybe.join(nodes.select("p1", "p2", "conv_id", "n_convs", "n_children", F.col("chars").alias("last_chars")), ["p1", "p2"]).select(
        "c", "d", "block", "p1", "p2",
        F.when(least, (F.col("n_convs") - 1) * F.col("last_chars")).otherwise(F.lit(0)).cast("long").alias("saved"),
        F.when(least & (F.col("d") == F.col("total")) & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("leaf"))
    own = F.lit(0).cast("long")
    tail_ends = tails.where("d = total").select("c", "d", "block", "p1", "p2", own.alias("saved"), (own + 1).alias("leaf"))
    sums = {"saved": F.sum("saved"), "leaf": F.sum("leaf")}
    summed = _carried(booked.withColumn("shared", F.lit(True)).unionByName(tail_ends.withColumn("shared", F.lit(False))), scratch, sums, True)
    below = summed.where("shared").groupBy("p1", "p2").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))

    ends = rows.where("shared and d = total").select("p1", "p2", "c")  # those of the root too
    ends = scratch.write(end_digests(scratch.write(ends, "ends")), "end-digests")
    parents = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    about = rows.agg(F.min("c").alias("root"), F.count_if(F.expr("d <= 1")).alias("n_convs"),
                     F.count_if(F.expr("not shared and d = total")).alias("tail_leaves")).first()
    root = about["root"]
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # a parent that is no node here has an estimate of one, and so the same member
    up = F.when(F.col("depth") == 1, F.lit(root)).otherwise(F.coalesce("parent_conv_id", "conv_id")).cast("long")
    inner = nodes.withColumnRenamed("d", "depth").join(parents, ["q1", "q2"], "left").withColumn("parent_conv_id", up).join(
        below, ["p1", "p2"]).join(ends, ["p1", "p2"], "left").fillna(EMPTY_SHA, ["ends_sha256"]).select(*columns)
    last = F.col("d") == F.col("total")
    tail = tails.select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), "q1", "q2", "parent_shared", (own + 1).alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), (own + 1).alias("n_leaves"), own.alias("saved_tokens"),
        F.when(last, F.sha2(F.col("c").cast("string").cast("binary"), 256)).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"))
    below_top = tail.where("not parent_shared").withColumn("parent_conv_id", F.col("conv_id")).select(*columns)
    tops = tail.where("parent_shared").join(parents, ["q1", "q2"], "left").withColumn("parent_conv_id", up).select(*columns)
    found = inner.unionByName(tops).unionByName(below_top)
    if root is None:
        return found
    at_root = "p1 = 0 and p2 = 0"
    sums = nodes.agg(F.sum((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), F.count_if(F.expr("n_children = 0")).alias("leaves")).first()
    kids = n_children.where(at_root).first()
    ending = ends.where(at_root).first()
    top = [(root, 0, None, about["n_convs"], kids["n_children"] if kids else 0, max(1, about["tail_leaves"] + sums["leaves"]),
            sums["saved"] or 0, ending["ends_sha256"] if ending else EMPTY_SHA)]
    return found.unionByName(turns.sparkSession.createDataFrame(
        top, "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))
