"""Categories of any number, as numbers and as sparse rows.

:class:`OrderedTargetEncoder` turns a category into the mean label of rows with
it. A training row is coded from rows *before* it in the order of a hash of its
id, in ``blocks`` steps, so that its own label never speaks for it; other rows
from all training rows. Nothing grows with the number of categories but a
table, which is aggregated and joined like any other.

:class:`Vocabulary` numbers the (column, value) pairs of a fitting frame
densely, as a written table; ``transform`` gives each row the sorted numbers of
its pairs (the ones of a sparse 0/1 vector), ``transform_long`` a row for each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendgrid.operators.ranking import in_blocks, offsets_of, RANGE
from spendgrid.operators.sampling import id_hash, row_id
from spendgrid.sources.store import written_once

NO_VALUE = "\x00"  # a null is a category like others


def _category(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NO_VALUE))


@dataclass
class OrderedTargetEncoder:
    """``fit_transform`` for training rows, ``transform`` for all others; both add
    ``<column>__mean``. ``weight`` rows of the overall mean are mixed into each."""

    columns: Sequence[str]
    label: str
    id_cols: Sequence[str]
    blocks: int = 16
    weight: float = 1.0
    tables: dict[str, DataFrame] = field(default_factory=dict)
    prior: float = 0.0

    def _block(self) -> Column:
        return (id_hash(row_id(self.id_cols), "order") % self.blocks).cast("int")

    def _mean(self, total: str, count: str) -> Column:
        zero = F.lit(0.0)
        return ((F.coalesce(F.col(total), zero) + F.lit(self.prior * self.weight)) / (F.coalesce(F.col(count), zero) + F.lit(self.weight)))

    def fit(self, train: DataFrame) -> "OrderedTargetEncoder":
        self.prior = float(train.agg(F.avg(F.col(self.label).cast("double"))).first()[0] or 0.0)
        y = F.col(self.label).cast("double")
        for c in self.columns:
            sums = train.groupBy(_category(c).alias("_value"), self._block().alias("_block")).agg(F.sum(y).alias("_y"), F.count(F.lit(1)).alias("_n"))
            # a value has at most ``blocks`` rows here
            earlier = Window.partitionBy("_value").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
            self.tables[c] = written_once(sums.select(
                "_value", "_block", F.sum("_y").over(earlier).alias("_y_before"), F.sum("_n").over(earlier).alias("_n_before"), "_y", "_n"), f"means-{c}")
        return self

    def fit_transform(self, train: DataFrame) -> DataFrame:
        """Training rows: a value's first block is coded by the overall mean. A
        value that a third of the rows share is joined in ``blocks`` parts."""
        self.fit(train)
        out = train
        for c in self.columns:
            known = self.tables[c].select("_value", "_block", self._mean("_y_before", "_n_before").alias(f"{c}__mean"))
            out = out.withColumns({"_value": _category(c), "_block": self._block()}).join(known, ["_value", "_block"], "left").drop("_value", "_block")
        return out.fillna({f"{c}__mean": self.prior for c in self.columns}) if self.columns else out

    def transform(self, df: DataFrame) -> DataFrame:
        """Other rows: all training rows of the value; the overall mean for a
        value that they do not have."""
        out = df
        for c in self.columns:
            whole = self.tables[c].groupBy("_value").agg(F.sum("_y").alias("_y"), F.sum("_n").alias("_n"))
            known = whole.select("_value", self._mean("_y", "_n").alias(f"{c}__mean"))
            out = out.withColumn("_value", _category(c)).join(known, "_value", "left").drop("_value")
        return out.fillna({f"{c}__mean": self.prior for c in self.columns}) if self.columns else out


class Vocabulary:
    """One-hot encoding whose vocabulary is a table (``column, value, number``)."""

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)
        self.table: DataFrame | None = None
        self.size = 0

    def _long(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """A row for each listed column that is not null."""
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in self.columns])
        return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.column", "_p.value").where(F.col("value").isNotNull())

    def fit(self, df: DataFrame) -> "Vocabulary":
        pairs = written_once(self._long(df, []).distinct(), "vocabulary-pairs")
        blocks = in_blocks(pairs, order=F.struct("column", "value"))
        joined = blocks.join(offsets_of(blocks), F.col(RANGE) == F.col("_in"))
        self.table = written_once(joined.select("column", "value", (F.col("_off_n") + F.col("_at") - 1).cast("int").alias("number")), "vocabulary")
        self.size = self.table.count()
        return self

    def transform_long(self, df: DataFrame, ids: Sequence[str]) -> DataFrame:
        """``ids, column, value, number``: the ones of each row; unseen values
        have none."""
        return self._long(df, ids).join(self.table, ["column", "value"]).select(*ids, "column", "value", "number")

    def transform(self, df: DataFrame, ids: Sequence[str]) -> DataFrame:
        """``ids``, sorted ``indices`` and ``size``: a sparse 0/1 vector per row,
        with one entry for each column at most. ``ids`` are unique."""
        ones = self.transform_long(df, ids).groupBy(*ids).agg(F.sort_array(F.collect_list("number")).alias("indices"))
        out = df.select(*ids).join(ones, list(ids), "left")
        return out.select(*ids, F.coalesce("indices", F.array().cast("array<int>")).alias("indices"), F.lit(self.size).alias("size"))
