"""Batch scoring flow: the model's features for one snapshot month ->
probabilities -> stored partition -> CSV export in parallel parts.

Scores are written once and the export reads the stored partition back, so
the scoring plan is not recomputed per output (the reference recomputed it
three times and collected it to the driver for the artifact).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrid.operators import matrix as mx
from spendgrid.operators import model as ml
from spendgrid.sources import store


def score_month(model: ml.TreeModel, master: DataFrame, *, category: str,
                snapshot_dt: str, categorical: Sequence[str],
                numeric: Sequence[str], indicators: Sequence[str] = ()
                ) -> DataFrame | None:
    """Scores of one category for one snapshot month; None when the month
    has no rows."""
    features = mx.score_input(master, categorical=categorical, numeric=numeric,
                              indicators=indicators, snapshot_dt=snapshot_dt)
    return ml.batch_scores(model, features, category)


def store_and_export(scores: DataFrame | None, *, table_path: str,
                     export_folder: str | None = None,
                     table_name: str = "scores",
                     write_dt: _dt.datetime | None = None) -> DataFrame | None:
    """Replace the scored month's partition, then export it as CSV parts in
    a folder named for the run. Nothing is written for empty scores."""
    if scores is None:
        return None
    store.overwrite_partitions(scores, table_path, ["snapshot_dt"])
    months = [r[0] for r in scores.select("snapshot_dt").distinct().collect()]
    stored = scores.sparkSession.read.parquet(table_path).where(
        F.col("snapshot_dt").isin(months))
    if export_folder is not None:
        store.export_csv(stored, export_folder, table_name,
                         write_dt or _dt.datetime.now())
    return stored
