"""Classes of nodes that share entries of an inverted list.

A list says that any two of its members may be linked; whether they are is
decided by an exact check. Pairs of a list are never all written out:

1. Of lists with equal members one is kept.
2. Each member is checked against the list's least member (a star).
3. Where a list's members are then still in several components, they are dealt
   to blocks, and each pair of blocks is compared in a task, which returns
   only links between different components.

So any two members of a list are connected, or were checked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendgrid.llm.common import Scratch
from spendgrid.llm.components import connected_components

BLOCK = 512
SALT = 8
BUCKET_ENTRIES = 1 << 20

Entries = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]]


def _sorted(entries: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (key, node), by key."""
    keys, nodes = entries
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    return keys[new], nodes[new]


def _packed(keys: np.ndarray, nodes: np.ndarray, bits: int, task: int) -> pa.RecordBatch:
    """A row for each bucket of leading bits."""
    cuts = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(1, np.int64)
    cuts = np.append(cuts, len(keys))
    full = np.flatnonzero(np.diff(cuts))
    return pa.RecordBatch.from_arrays([
        pa.array(full, pa.int64()), pa.array([task % SALT] * len(full), pa.int64()), pa.array([1] * len(full), pa.int64()),
        pa.array([keys[cuts[b]:cuts[b + 1]].tobytes() for b in full], pa.binary()),
        pa.array([nodes[cuts[b]:cuts[b + 1]].tobytes() for b in full], pa.binary())], names=["bucket", "salt", "kind", "keys", "nodes"])


_PACKED = "bucket bigint, salt bigint, kind bigint, keys binary, nodes binary"


def _first_pass(entries: Entries, bits: int):
    def run(batches):
        for keys, nodes in map(_sorted, entries(batches)):
            change = keys[1:] != keys[:-1]
            first, last = np.append(True, change), np.append(change, True)
            yield _packed(keys[first | last], nodes[first | last], bits, 0)
    return run


def _second_pass(entries: Entries, bits: int):
    def run(batches):
        for k, (keys, nodes) in enumerate(map(_sorted, entries(batches))):
            yield _packed(keys, nodes, bits, TaskContext.get().partitionId() + k)
    return run


def _unpack(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _shared_keys(key, group):
    keys, nodes = _unpack(group.column("keys"), np.uint64), _unpack(group.column("nodes"), np.int64)
    order = np.argsort(keys, kind="stable")
    keys, nodes = keys[order], nodes[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    several = np.minimum.reduceat(nodes, first) != np.maximum.reduceat(nodes, first)
    shared = keys[first][several]
    return pa.table({"bucket": [key[0].as_py()] if len(shared) else pa.array([], pa.int64()),
                     "keys": pa.array([shared.tobytes()] if len(shared) else [], pa.binary())})


def _members(batches):
    """Rows come by bucket and salt, the shared keys of a bucket first."""
    at, shared = None, np.zeros(0, np.uint64)
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for bucket, salt, kind, keys, nodes in zip(*columns):
            if kind == 0:
                at, shared = (bucket, salt), np.frombuffer(keys, np.uint64)
            elif at == (bucket, salt):
                keys = np.frombuffer(keys, np.uint64)
                place = np.minimum(np.searchsorted(shared, keys), len(shared) - 1)
                hit = shared[place] == keys
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[hit].view(np.int64)), pa.array(np.frombuffer(nodes, np.int64)[hit])], names=["value", "node"])


def shared_entries(rows: DataFrame, entries: Entries, n_entries: int, scratch: Scratch) -> DataFrame:
    """Distinct ``value, node`` for the keys that two nodes share. ``entries``
    turns the Arrow batches of a task's ``rows`` into arrays (uint64 keys,
    int64 nodes), of bounded length each.

    Keys are moved packed, by the bucket of their leading bits, not row by row.
    A first pass finds those that two nodes share; at most two nodes of a key
    go on from each batch. A second pass sends the nodes of all keys to where
    the shared ones of their bucket are; a bucket's nodes are dealt to
    ``SALT`` tasks and read there as a stream, so a key that very many nodes
    hold fills no task's memory.
    """
    bits = int(np.ceil(np.log2(max(n_entries / BUCKET_ENTRIES, 1))))
    first = rows.mapInArrow(_first_pass(entries, bits), _PACKED)
    shared = scratch.write(first.groupBy("bucket").applyInArrow(_shared_keys, "bucket bigint, keys binary"), "shared")
    dealt = rows.mapInArrow(_second_pass(entries, bits), _PACKED).union(shared.select(
        "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))).alias("salt"),
        F.lit(0).cast("long").alias("kind"), "keys", F.lit(None).cast("binary").alias("nodes")))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = dealt.repartition(tasks, "bucket", "salt").sortWithinPartitions("bucket", "salt", "kind").mapInArrow(
        _members, "value bigint, node bigint")
    entries = scratch.write(found.distinct(), "entries")
    scratch.drop(shared)
    return entries


def distinct_lists(entries: DataFrame, scratch: Scratch) -> DataFrame:
    """``value, size, center, node`` of all lists with two members or more, once
    for each set of members. ``entries``: distinct rows (value, node)."""
    about = entries.groupBy("value").agg(
        F.count("*").alias("size"), F.min("node").alias("center"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark")).where("size > 1")
    once = scratch.write(about.groupBy("size", "center", "mark").agg(F.min("value").alias("value")), "lists")
    members = scratch.write(entries.join(once, "value").select("value", "size", "center", "node"), "members")
    scratch.drop(entries, once)
    return members


def blocks_of(placed: DataFrame, n_blocks: Column) -> DataFrame:
    """Rows (value, size, node, ...) dealt to pairs of blocks (``i <= j``);
    ``block`` is the row's own. ``n_blocks``: how many a list has."""
    n = n_blocks.cast("long")
    spread = placed.withColumn("block", F.pmod(F.xxhash64("node"), n)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    return spread.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "size")


def whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows that come sorted by ``by``, in tables that hold groups as a whole,
    with the offsets of their groups and the end."""
    held: list[pa.RecordBatch] = []

    def out(table: pa.Table, last: bool) -> tuple[pa.Table, np.ndarray, pa.Table]:
        keys = [table.column(c).to_numpy() for c in by]
        new = np.ones(table.num_rows, dtype=bool)
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        cuts = np.append(np.flatnonzero(new), table.num_rows)
        end = int(cuts[-1] if last else cuts[-2])
        return table.slice(0, end), cuts[cuts <= end], table.slice(end)

    for batch in batches:
        if batch.num_rows:
            table, cuts, rest = out(pa.Table.from_batches([*held, batch]), False)
            held = rest.combine_chunks().to_batches()
            if table.num_rows:
                yield table.combine_chunks(), cuts
    if held:
        table, cuts, _ = out(pa.Table.from_batches(held), True)
        yield table.combine_chunks(), cuts


def pairs_within(cuts: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (x, y), x before y, of rows of one group, about ``most`` at a
    time."""
    size = np.diff(cuts)
    after = np.repeat(cuts[1:], size) - np.arange(cuts[0], cuts[-1]) - 1  # partners of each row
    total = np.cumsum(after)
    at = 0
    while at < len(after):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, side="right")))
        many = after[at:stop]
        x = np.repeat(np.arange(at, stop), many)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many)
        yield x + cuts[0], y + cuts[0]
        at = stop


def dealt_by_group(dealt: DataFrame) -> DataFrame:
    """Rows of a pair of blocks one after the other, in one task."""
    tasks = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "value", "i", "j").sortWithinPartitions("value", "i", "j")


def classes(members: DataFrame, scratch: Scratch, check: Callable[[DataFrame, str], DataFrame],
            compare: Callable[[DataFrame], DataFrame], block: int = BLOCK) -> DataFrame:
    """``node, root`` of all linked nodes, roots included.

    ``check(pairs, name)`` returns the linked ones of pairs (a, b).
    ``compare(dealt)`` returns links (a, b) between rows of different ``comp``
    within each (value, i, j). ``block``: members of a block at most.
    """
    stars = members.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    links = check(stars, "star-links")
    first = connected_components(links, scratch)
    placed = members.where("size > 2").join(first, "node", "left").select(
        "value", "size", "node", F.coalesce("root", "node").alias("comp"))
    still_open = placed.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("value")
    more = scratch.write(compare(blocks_of(
        placed.join(still_open, "value", "left_semi"), F.ceil(F.col("size") / block))).distinct(), "block-links")
    found = scratch.write(connected_components(links.union(more), scratch), "roots")
    return found.select("node", "root").union(found.select("root", "root")).distinct()
