"""Training, parameter search and batch scoring with Spark ML.

The reference trains gradient-boosted trees on a pandas frame collected to
the driver; here the frame stays distributed: ``StringIndexer`` +
``VectorAssembler`` + ``GBTClassifier`` in one ``Pipeline``. Scores differ
from the reference's library (different trees), so tests check shape,
range, determinism and separation rather than values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import pandas as pd
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrid.operators.encoding import OrderedTargetEncoder
from spendgrid.operators.metrics import coverage_at
from spendgrid.operators.search import maximise
from spendgrid.sources.store import written_once

SEED = 42


@dataclass(frozen=True)
class TreeParams:
    learning_rate: float = 0.1
    num_trees: int = 50
    depth: int = 4
    min_info_gain: float = 0.0


# The reference's search space (rate, trees, l2, depth). GBT
# in Spark has no l2 leaf penalty; the l2 range maps onto min_info_gain.
SEARCH_SPACE = {"learning_rate": (0.01, 0.50), "num_trees": (50, 500),
                "l2_leaf_reg": (1, 10), "depth": (2, 6)}


def params_of(point: dict) -> TreeParams:
    return TreeParams(learning_rate=float(point["learning_rate"]), num_trees=int(point["num_trees"]), depth=int(point["depth"]),
                      min_info_gain=point["l2_leaf_reg"] / 1000.0)


# A tree splits a category of up to this many values by the values themselves;
# beyond it, by their mean label (a number), so bins never follow the data.
FEW_VALUES = 40
BINS = 64
PATIENCE = 30


@dataclass
class TreeModel:
    """Encoder of large categories, and the fitted trees behind it."""

    pipeline: PipelineModel
    encoder: OrderedTargetEncoder | None
    losses: list[float]  # on the evaluation rows, after each tree that was grown

    @property
    def trees(self):
        return self.pipeline.stages[-1]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(self.encoder.transform(df) if self.encoder else df)


def build_pipeline(categorical: Sequence[str], numeric: Sequence[str],
                   params: TreeParams = TreeParams(), label: str = "label", bins: int = BINS) -> Pipeline:
    idx = [f"{c}__idx" for c in categorical]
    stages = [StringIndexer(inputCols=list(categorical), outputCols=idx,
                            handleInvalid="keep")] if categorical else []
    stages.append(VectorAssembler(inputCols=idx + list(numeric), outputCol="features",
                                  handleInvalid="keep"))
    stages.append(GBTClassifier(labelCol=label, featuresCol="features", seed=SEED,
                                maxIter=params.num_trees, stepSize=params.learning_rate,
                                maxDepth=params.depth, minInfoGain=params.min_info_gain,
                                maxBins=bins))
    return Pipeline(stages=stages)


def large_categories(train: DataFrame, categorical: Sequence[str], few: int = FEW_VALUES) -> list[str]:
    """The columns with more than ``few`` values, by one sketch aggregate."""
    if not categorical:
        return []
    row = train.agg(*[F.approx_count_distinct(c).alias(c) for c in categorical]).first()
    return [c for c in categorical if row[c] > few]


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Number of trees up to the least loss before ``patience`` trees brought no
    gain, and whether that many were seen."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def cut_trees(model: PipelineModel, n: int) -> PipelineModel:
    """The model of the first ``n`` trees."""
    last = model.stages[-1]
    if n >= last.getNumTrees:
        return model
    jvm = last._java_obj
    gateway = SparkContext._active_spark_context._gateway
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    for k in range(n):
        trees[k], weights[k] = jvm.trees()[k], jvm.treeWeights()[k]
    cut = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(jvm.uid(), trees, weights, jvm.numFeatures(), 2)
    jvm.copyValues(cut, jvm.extractParamMap())
    return PipelineModel(stages=[*model.stages[:-1], GBTClassificationModel(cut)])


def _dealt(rows: DataFrame, ids: Sequence[str], name: str) -> DataFrame:
    """``rows`` written in as many parts as the cluster runs tasks: every pass of
    the fit uses all of it, however few files the rows came from."""
    return written_once(rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, *ids), name)


def fit(train: DataFrame, categorical, numeric, params: TreeParams = TreeParams(),
        label: str = "label", validation_col: str | None = None, id_cols: Sequence[str] | None = None,
        patience: int = PATIENCE) -> TreeModel:
    """Fit gradient-boosted trees.

    Columns of more than ``FEW_VALUES`` values are coded by their mean label
    (:class:`~spendgrid.operators.encoding.OrderedTargetEncoder`) over ``id_cols``
    (all columns, if not given). With ``validation_col`` (a boolean column that
    marks evaluation rows) trees are grown until ``patience`` of them bring no
    gain in loss on those rows, and those after the best one are cut off. Trees
    are grown in rounds of twice as many, so at most about twice as many as
    needed; a tree depends only on those before it.
    """
    rows = train.where(~F.col(validation_col)) if validation_col else train
    large = large_categories(rows, categorical)
    few = [c for c in categorical if c not in large]
    ids = list(id_cols or [c for c in train.columns if c not in (label, validation_col)])
    encoder = OrderedTargetEncoder(large, label, ids) if large else None
    coded = _dealt(encoder.fit_transform(rows) if encoder else rows, ids, "coded")
    columns = [f"{c}__mean" for c in large]
    if not validation_col:
        return TreeModel(build_pipeline(few, [*numeric, *columns], params, label).fit(coded), encoder, [])
    valid = train.where(F.col(validation_col))
    valid = _dealt(encoder.transform(valid) if encoder else valid, ids, "evaluation")
    n = min(params.num_trees, 2 * patience)
    while True:
        model = build_pipeline(few, [*numeric, *columns], replace(params, num_trees=n), label).fit(coded)
        ready = valid
        for stage in model.stages[:-1]:
            ready = stage.transform(ready)
        losses = list(model.stages[-1].evaluateEachIteration(ready)) if not valid.isEmpty() else []
        best, done = best_round(losses, patience) if losses else (n, True)
        if done or n >= params.num_trees or len(losses) < n:
            return TreeModel(cut_trees(model, best), encoder, losses)
        n = min(params.num_trees, 2 * n)


def predict(model: TreeModel, df: DataFrame, out_col: str,
            keep: Sequence[str]) -> DataFrame:
    """Positive-class probability beside the kept columns."""
    scored = model.transform(df)
    return scored.select(*keep, vector_to_array("probability")[1].alias(out_col))


class CoverageEvaluator(Evaluator):
    """Share of positives in the top 30 % by score (larger is better)."""

    def __init__(self, label: str = "label", id_col: str = "id", deciles: int = 3):
        super().__init__()
        self.label, self.id_col, self.deciles = label, id_col, deciles

    def _evaluate(self, dataset: DataFrame) -> float:
        df = dataset.select(self.id_col, self.label,
                            vector_to_array("probability")[1].alias("score"))
        row = coverage_at(df, self.label, "score", self.id_col, self.deciles).first()
        return float(row[0] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def search(train: DataFrame, valid: DataFrame, categorical, numeric, *,
           max_evals: int = 4, parallelism: int = 4, label: str = "label",
           id_col: str = "id", seed: int = SEED, space=SEARCH_SPACE) -> tuple[TreeParams, float]:
    """Parameters with the best coverage at 30 % of ``valid``, found by
    :func:`spendgrid.operators.search.maximise`. Each trial is fitted on
    ``train`` with ``valid`` for its early stop, ``parallelism`` at a time
    (each trial is itself a distributed job)."""
    ev = CoverageEvaluator(label, id_col)
    both = written_once(train.withColumn("_is_valid", F.lit(False)).unionByName(valid.withColumn("_is_valid", F.lit(True))), "search")

    def trial(point: dict) -> float:
        model = fit(both, categorical, numeric, params_of(point), label, "_is_valid", [id_col])
        return ev.evaluate(model.transform(both.where("_is_valid")))

    best, score, _ = maximise(trial, space, max_evals=max_evals, seed=seed, parallelism=parallelism)
    return params_of(best), score


def batch_scores(model: TreeModel, features: DataFrame, category: str,
                 ids: Sequence[str] = ("snapshot_dt", "elc_master_id",
                                       "consumer_id", "brand_id")) -> DataFrame | None:
    """Scores of one category beside the ids; None for an empty input."""
    if features.isEmpty():
        return None
    return predict(model, features, f"pred_proba_{category}", ids)


def pandas_scorer(spark, model, features: Sequence[str]):
    """Vectorised scorer for a foreign model object (anything with
    ``predict_proba(pandas.DataFrame)``): an Arrow ``pandas_udf`` over the
    feature columns. The model travels once per executor as a broadcast
    variable, not inside every task closure.
    """
    from pyspark import cloudpickle
    from pyspark.sql.functions import pandas_udf

    names = list(features)
    # cloudpickle bytes: any model object (also classes defined in a notebook)
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(model))
    cache: dict = {}

    @pandas_udf("double")
    def _score(x: pd.DataFrame) -> pd.Series:
        if "m" not in cache:  # once per task, not per Arrow batch
            cache["m"] = cloudpickle.loads(shared.value)
        x = x.copy()
        x.columns = names
        return pd.Series(cache["m"].predict_proba(x)[:, 1])

    def score(*cols):
        """Score column over the feature columns (sent as one struct, which
        arrives in Python as a pandas DataFrame)."""
        from pyspark.sql import functions as F
        return _score(F.struct(*cols))

    return score
