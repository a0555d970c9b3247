"""Repeatable sampling and splits keyed on an id hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendgrid.operators.ranking import ordered_running

SPACE = 2 ** 32


def id_hash(col: str | Column, salt: str = "") -> Column:
    """Repeatable 32-bit bucket of an id: the first 8 hex digits of the md5
    of ``salt || id`` (same value in any engine with md5). Draws that must
    be independent of each other (a split and a sample of it) use different
    salts."""
    c = F.col(col) if isinstance(col, str) else col
    text = c.cast("string")
    if salt:
        text = F.concat(F.lit(salt), text)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_sample(df: DataFrame, id_cols: str | Sequence[str], fraction: float,
                salt: str = "") -> DataFrame:
    """Rows whose id hash falls below ``fraction`` of the hash space: the
    same ids on every run and partitioning (a seeded ``sample`` depends on
    the partition layout)."""
    return df.where(id_hash(row_id(id_cols), salt) < F.lit(int(fraction * SPACE)))


def row_id(id_cols: str | Sequence[str]) -> Column:
    """Text id of a row from one or more key columns ('|'-joined)."""
    cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    if len(cols) == 1:
        return F.col(cols[0]).cast("string")
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def hash_limit(df: DataFrame, id_cols: str | Sequence[str], n: int) -> DataFrame:
    """``n`` rows chosen by smallest id hash (then the ids): a repeatable
    ``limit``. Planned as a distributed top-n (each task keeps its best n)."""
    cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    return df.orderBy(id_hash(row_id(cols)), *[F.col(c) for c in cols]).limit(n)


def last_digit_sample(df: DataFrame, id_col: str,
                      digits: Sequence[str] = ("1",)) -> DataFrame:
    """Rows whose id ends in one of ``digits`` (as text)."""
    return df.where(F.substring(F.col(id_col).cast("string"), -1, 1)
                    .isin(list(digits)))


def stratified_split(df: DataFrame, *, id_cols: str | Sequence[str], label_col: str,
                     test_size: float = 0.3, ranges: int | None = None,
                     salt: str = "") -> DataFrame:
    """Add ``split`` = 'test' / 'train' with exactly ceil(test_size * n)
    test rows in every label, chosen by id hash order (then id).

    The rank inside a label comes from :func:`ordered_running`, so a label
    holding most rows is still ranked across many tasks.
    """
    cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    ranked = ordered_running(
        df.withColumn("_h", id_hash(row_id(cols), salt)), order="_h", groups=[label_col],
        tiebreak=cols, ranges=ranges)
    sizes = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n_label"))
    j = ranked.join(sizes, label_col, "inner")
    is_test = F.col("_rank") <= F.ceil(F.col("_n_label") * F.lit(test_size))
    return j.select(*df.columns,
                    F.when(is_test, "test").otherwise("train").alias("split"))
