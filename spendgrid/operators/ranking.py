"""Exact ranks and running totals in a global order, without a global window.

``Window.orderBy(...)`` with no partition moves every row into one task.
Instead:

1. Rows are dealt to ranges of the whole sort key: groups, value, *and* the tie
   break. Spark samples the key and cuts it into ranges of about equal size, so
   rows that share a value are split by their ids; a score that half of all rows
   hold takes up half of the ranges and not one of them.
2. Each range is sorted and numbered where it lies, in one pass over its rows
   (blocks: running totals from the block's beginning), and written once. That
   is the only shuffle of the rows.
3. The blocks' totals, one row for each range and group, are summed up to
   offsets, and every row adds the offset of its block.

Results are exact whatever the ranges are. Only rows equal in the whole key
cannot be parted, so a tie break should make the order total.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendgrid.sources.store import written_once

RANGE = "_range"
ROWS_PER_RANGE = 50_000  # rows may be wide


def range_count(rows: int, rows_per_range: int = ROWS_PER_RANGE,
                minimum: int = 1) -> int:
    """Ranges so that one range (one task) holds about ``rows_per_range`` rows."""
    return max(minimum, -(-rows // rows_per_range))


def _numbered(columns: list[str], sums: list[str]):
    """Numbers and running totals of a task's sorted rows, from 1 in every group
    (``_group`` tells neighbouring groups apart)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, count, totals = None, 0, [0] * len(sums)
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            first = np.append(count == 0 or group != at[0], at[1:] != at[:-1])
            # the row of this batch at which the row's group begins; -1 if in an earlier batch
            begin = np.maximum.accumulate(np.where(first, np.arange(len(at)), -1))
            carried = begin < 0
            number = np.arange(len(at)) - np.maximum(begin, 0) + 1 + carried * count
            out = [pa.array(number)]
            for k, name in enumerate(sums):
                running = np.cumsum(batch.column(columns.index(name)).fill_null(0).to_numpy(zero_copy_only=False))
                before = np.where(begin > 0, running[begin - 1], 0)
                running = np.where(carried, running + totals[k], running - before)
                totals[k] = running[-1]
                out.append(pa.array(running))
            group, count = at[-1], int(number[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.full(len(at), TaskContext.get().partitionId(), dtype=np.int32)), *out],
                names=[*columns, RANGE, "_at", *[f"_to_{s}" for s in sums]])
    return run


def in_blocks(df: DataFrame, *, order: Column, sums: Sequence[str] = (), groups: Sequence[str] = (),
              tiebreak: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``df``, written, with each row's range, its number ``_at`` and the running
    totals ``_to_<sum>`` inside the range and group."""
    if ranges is None:
        ranges = range_count(df.count())
    sums, groups = list(sums), list(groups)
    group = F.xxhash64(*[F.col(g) for g in groups]) if groups else F.lit(0).cast("long")
    keyed = df.withColumn("_key", order).withColumn("_group", group)
    by = [*groups, "_key", *tiebreak]
    # unequal groups of equal hash would have to be neighbours to be taken for one
    dealt = keyed.repartitionByRange(ranges, *by).sortWithinPartitions(*by).drop("_key")
    kinds = dict(df.dtypes)
    total = {s: "double" if kinds[s] in ("double", "float") else "bigint" for s in sums}
    wide = dealt.select(*[F.col(c).cast(total[c]).alias(c) if c in total else F.col(c) for c in df.columns], "_group")
    schema = ", ".join([f"`{c}` {total.get(c, kinds[c])}" for c in df.columns]
                       + [f"{RANGE} int, _at bigint"] + [f"`_to_{s}` {total[s]}" for s in sums])
    return written_once(wide.mapInArrow(_numbered(df.columns, sums), schema), "ranked")


def offsets_of(blocks: DataFrame, sums: Sequence[str] = (), groups: Sequence[str] = ()) -> DataFrame:
    """What comes before each block in its group: a row for each range and group."""
    totals = blocks.groupBy(*groups, RANGE).agg(F.max("_at").alias("_n"), *[F.sum(s).alias(f"_s_{s}") for s in sums])
    before = Window.partitionBy(*groups).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*[F.col(g).alias(f"_of_{g}") for g in groups], F.col(RANGE).alias("_in"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off_n"),
                         *[F.coalesce(F.sum(f"_s_{s}").over(before), F.lit(0)).alias(f"_off_{s}") for s in sums])


def ordered_running(df: DataFrame, *, order: str, sums: Sequence[str] = (),
                    groups: Sequence[str] = (), descending: bool = False,
                    tiebreak: Sequence[str] = (), ranges: int | None = None,
                    rank_col: str = "_rank") -> DataFrame:
    """Add, per ``groups``, the 1-based rank of each row in ``order``
    (then ``tiebreak``; nulls first) and inclusive running sums ``<c>_cum`` of ``sums``.

    Exact; ties in (order, tiebreak) are ranked in an arbitrary order, so
    pass a tiebreak that makes the order total when ranks matter.
    ``ranges`` defaults to one per ``ROWS_PER_RANGE`` rows (one count of the input), so a
    range stays a task-sized piece however large the input grows and however
    many rows share a value.
    """
    groups, sums = list(groups), list(sums)
    key = -F.col(order) if descending else F.col(order)
    blocks = in_blocks(df, order=key, sums=sums, groups=groups, tiebreak=tiebreak, ranges=ranges)
    offsets = offsets_of(blocks, sums, groups)
    # one row per range and group; null groups meet null groups
    on = [F.col(RANGE) == F.col("_in"), *[F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in groups]]
    joined = blocks.join(offsets, on, "inner")
    return joined.select(*df.columns, (F.col("_off_n") + F.col("_at")).alias(rank_col),
                         *[(F.col(f"_off_{s}") + F.col(f"_to_{s}")).alias(f"{s}_cum") for s in sums])
