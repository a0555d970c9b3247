"""Binary classifier quality metrics as distributed aggregates.

Every metric reads a (label 0/1, score) frame. Rank-based metrics share one
:class:`ScoreCurve`: equal scores are collapsed (grouped aggregate with map-side
combine), and the collapsed rows take their running totals in score order in
blocks (:mod:`spendgrid.operators.ranking`): one shuffle of the rows, one of the
scores, no quantile pass. The curve is written once; each metric, or all five of
them, is one aggregate over it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendgrid.operators.ranking import ordered_running, range_count
from spendgrid.sources.store import written_once

DIGITS = 6


@dataclass(frozen=True)
class ScoreCurve:
    """``points``: score, pos, neg and their totals from the highest score down
    (``pos_cum``, ``neg_cum``); ``positives`` and ``negatives`` in all."""

    points: DataFrame
    positives: int
    negatives: int

    @property
    def rows(self) -> int:
        return self.positives + self.negatives


def score_curve(df: DataFrame, label: str = "label", score: str = "score", ranges: int | None = None) -> ScoreCurve:
    y = F.col(label).cast("int")
    by_score = written_once(df.groupBy(F.col(score).alias("score")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")), "by_score")
    total = by_score.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.count(F.lit(1)).alias("scores")).first()
    points = ordered_running(by_score, order="score", sums=["pos", "neg"], descending=True, ranges=ranges or range_count(total["scores"]))
    return ScoreCurve(points, int(total["p"] or 0), int(total["n"] or 0))


def _average_precision(c: ScoreCurve) -> Column:
    precision = F.col("pos") * (F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum")))
    return F.sum(precision) / F.lit(float(c.positives)) if c.positives else F.lit(None)


def _roc_auc(c: ScoreCurve) -> Column:
    if not c.positives or not c.negatives:
        return F.lit(None)
    below = F.lit(float(c.negatives)) - F.col("neg_cum")
    return F.sum(F.col("pos") * (below + F.col("neg") / 2.0)) / F.lit(float(c.positives * c.negatives))


def _ks(c: ScoreCurve) -> Column:
    if not c.positives or not c.negatives:
        return F.lit(None)
    p, n = F.lit(float(c.positives)), F.lit(float(c.negatives))
    return F.max(F.abs((n - F.col("neg_cum") + F.col("neg")) / n - (p - F.col("pos_cum") + F.col("pos")) / p))


def _brier(c: ScoreCurve) -> Column:
    off = F.col("pos") * F.pow(F.col("score") - 1.0, 2.0) + F.col("neg") * F.pow(F.col("score"), 2.0)
    return F.sum(off) / F.lit(float(c.rows)) if c.rows else F.lit(None)


def _rounded(value: Column, name: str) -> Column:
    return F.round(value.cast("double"), DIGITS).alias(name)


def average_precision(df: DataFrame, label: str = "label", score: str = "score",
                      ranges: int | None = None) -> DataFrame:
    """Step-wise average precision: sum over score thresholds of
    (recall gained) x (precision at the threshold); ties form one step."""
    c = score_curve(df, label, score, ranges)
    return c.points.agg(_rounded(_average_precision(c), "avg_precision"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            ranges: int | None = None) -> DataFrame:
    """Area under the ROC curve; a tied positive/negative pair counts 1/2."""
    c = score_curve(df, label, score, ranges)
    return c.points.agg(_rounded(_roc_auc(c), "roc_auc"))


def ks_statistic(df: DataFrame, label: str = "label", score: str = "score",
                 ranges: int | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic between the score
    distributions of negatives and positives."""
    c = score_curve(df, label, score, ranges)
    return c.points.agg(_rounded(_ks(c), "ks_score"))


def brier_score(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    err = F.col(score) - F.col(label).cast("double")
    return df.agg(F.round(F.avg(err * err), DIGITS).alias("brier_score"))


def _positives_in_top(df: DataFrame, c: ScoreCurve, label: str, score: str, id_col: str, deciles: int, ranges: int | None) -> int:
    """Positives among the first ``n // 10 * deciles`` rows. Scores wholly above
    the cut come from the curve; only the rows of the score at the cut, if it is
    cut through and mixed, are put in the order of their ids."""
    k = c.rows // 10 * deciles
    upto = F.col("pos_cum") + F.col("neg_cum")
    whole = upto <= k
    # among the scores that reach beyond the cut, the first
    cut = F.min_by(F.struct("score", "pos", "neg"), F.when(~whole, upto))
    at = c.points.agg(F.sum(F.when(whole, F.col("pos"))).alias("pos"), F.max(F.when(whole, upto)).alias("rows"), cut.alias("cut")).first()
    found, left = int(at["pos"] or 0), k - int(at["rows"] or 0)
    if not left or not at["cut"] or not at["cut"]["pos"]:
        return found
    if not at["cut"]["neg"]:
        return found + left
    value = at["cut"]["score"]
    tied = df.where(F.col(score).isNull() if value is None else F.col(score) == F.lit(value)).select(id_col, label)
    ranked = ordered_running(tied, order=id_col, ranges=ranges or range_count(at["cut"]["pos"] + at["cut"]["neg"]))
    return found + int(ranked.where(F.col("_rank") <= left).agg(F.sum(F.col(label).cast("int"))).first()[0] or 0)


def coverage_at(df: DataFrame, label: str = "label", score: str = "score",
                id_col: str = "id", deciles: int = 3, ranges: int | None = None,
                curve: ScoreCurve | None = None) -> DataFrame:
    """Share of all positives among the top ``n // 10 * deciles`` rows by
    score (ties broken by id)."""
    c = curve or score_curve(df, label, score, ranges)
    top = _positives_in_top(df, c, label, score, id_col, deciles, ranges) if c.positives else None
    value = None if top is None else round(top / c.positives, DIGITS)
    return df.sparkSession.createDataFrame([(value,)], f"cov_at_decile_{deciles} double")


def classifier_report(df: DataFrame, label: str = "label", score: str = "score",
                      id_col: str = "id", ranges: int | None = None) -> DataFrame:
    """All five metrics, one (metric, value) row each, from one curve. ``df`` is
    read a second time only for rows tied at the coverage cut."""
    c = score_curve(df, label, score, ranges)
    names = {"avg_precision": _average_precision(c), "roc_auc": _roc_auc(c), "brier_score": _brier(c), "ks_score": _ks(c)}
    one = c.points.agg(*[_rounded(value, name) for name, value in names.items()]).first()
    values = [(name, one[name]) for name in names]
    cover = coverage_at(df, label, score, id_col, 3, ranges, c)
    values.append((cover.columns[0], cover.first()[0]))
    return df.sparkSession.createDataFrame(values, "metric string, value double")
