"""Training flow: training slice of the master table -> model matrix ->
stratified split -> seeded Parzen search -> final fit -> metrics.

The frame never leaves Spark; only the chosen parameters and the metric
rows reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrid.operators import matrix as mx
from spendgrid.operators import metrics as met
from spendgrid.operators import model as ml
from spendgrid.operators import sampling as smp

IDS = ("elc_master_id", "consumer_id", "brand_id")


@dataclass
class TrainingResult:
    model: ml.TreeModel
    params: ml.TreeParams
    categorical: list[str]
    numeric: list[str]
    report: DataFrame  # (split, metric, value)


def training_slice(master: DataFrame, snapshot_dt: str,
                   id_digits: Sequence[str] = ("1",)) -> DataFrame:
    """One snapshot month, consumers known to CDP, ids ending in the given
    digits (the reference's training query)."""
    rows = master.where((F.col("snapshot_dt") == F.lit(snapshot_dt).cast("date"))
                        & (F.col("exists_in_cdp") == "Y"))
    return smp.last_digit_sample(rows, "consumer_id", id_digits)


def train(master: DataFrame, *, target: str, snapshot_dt: str,
          search_fraction: float = 0.3, test_size: float = 0.3,
          max_evals: int = 1, parallelism: int = 4, space=ml.SEARCH_SPACE) -> TrainingResult:
    """Search on a hash sample of the slice, fit on the full train split
    (early stop on the test split), report metrics on both splits."""
    from spendgrid.plans.preparation import materialize
    rows = training_slice(master, snapshot_dt)
    # the matrix and the split are read by every trial and the final fit:
    # written once to the shared checkpoint folder
    m = materialize(mx.model_matrix(rows, target, keep_ids=IDS), "train_matrix")
    split = smp.stratified_split(m, id_cols=list(IDS), label_col="label",
                                 test_size=test_size)
    split = materialize(split.withColumn("id", smp.row_id(list(IDS))), "train_split")
    cat, ind, num = mx.feature_kinds(split.drop("label", "split", "id"), drop=IDS)
    categorical = cat + ind
    # a draw independent of the split (own salt), else the sample would be
    # made of the split's test rows
    search_rows = smp.hash_sample(split, "id", search_fraction, salt="search")
    best, _ = ml.search(search_rows.where(F.col("split") == "train"),
                        search_rows.where(F.col("split") == "test"),
                        categorical, num, max_evals=max_evals,
                        parallelism=parallelism, space=space)
    fit_rows = split.withColumn("is_valid", F.col("split") == "test")
    model = ml.fit(fit_rows, categorical, num, best, validation_col="is_valid", id_cols=["id"])
    # written once: the metrics of both splits read it
    scored = materialize(ml.predict(model, split, "score", ["id", "label", "split"]), "train_scored")
    parts = []
    for name in ("train", "test"):
        rep = met.classifier_report(scored.where(F.col("split") == name))
        parts.append(rep.select(F.lit(name).alias("split"), "metric", "value"))
    return TrainingResult(model, best, categorical, num, parts[0].unionByName(parts[1]))
