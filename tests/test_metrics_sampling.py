import random

import numpy as np
import pytest

from spendgrid.operators import metrics as met
from spendgrid.operators import sampling as smp
from spendgrid.operators.ranking import ordered_running


def brute(labels, scores):
    y, s = np.array(labels), np.array(scores)
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg])
    order = sorted(set(s), reverse=True)
    ap, P = 0.0, y.sum()
    for t in order:
        tp, fp = ((s >= t) & (y == 1)).sum(), ((s >= t) & (y == 0)).sum()
        ap += ((s == t) & (y == 1)).sum() / P * tp / (tp + fp)
    grid = sorted(set(s))
    ks = max(abs((neg <= x).mean() - (pos <= x).mean()) for x in grid)
    ids = np.arange(len(s))
    top = sorted(ids, key=lambda i: (-s[i], i))[: len(s) // 10 * 3]
    cov = y[top].sum() / P
    brier = np.mean((s - y) ** 2)
    return dict(roc_auc=auc, avg_precision=ap, ks_score=ks, cov_at_decile_3=cov,
                brier_score=brier)


def frame(spark, labels, scores):
    return spark.createDataFrame([(i, int(l), float(s)) for i, (l, s) in
                                  enumerate(zip(labels, scores))],
                                 "id long, label int, score double")


@pytest.mark.parametrize("seed", [1, 2])
def test_metrics_match_brute_force(spark, seed):
    rng = random.Random(seed)
    n = 300
    labels = [rng.random() < 0.3 for _ in range(n)]
    scores = [round(rng.random() * 0.5 + (0.3 if l else 0.0), 2) for l in labels]  # ties
    want = brute(labels, scores)
    rep = {r.metric: r.value for r in
           met.classifier_report(frame(spark, labels, scores), ranges=7).collect()}
    for k, v in want.items():
        assert rep[k] == pytest.approx(v, abs=2e-6), k


def test_metrics_edge_cases(spark):
    df = frame(spark, [0, 1, 0, 1], [0.5, 0.5, 0.5, 0.5])
    assert met.roc_auc(df).first()[0] == 0.5
    df = frame(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])
    assert met.roc_auc(df).first()[0] == 1.0
    assert met.average_precision(df).first()[0] == 1.0
    assert met.ks_statistic(df).first()[0] == 1.0
    rev = frame(spark, [0, 0, 1, 1], [-0.1, -0.2, -0.8, -0.9])
    assert met.roc_auc(rev).first()[0] == 0.0


def test_ordered_running_exact_with_many_ranges(spark):
    rng = random.Random(5)
    vals = [(i, rng.randint(0, 50), rng.randint(0, 3)) for i in range(500)]
    df = spark.createDataFrame(vals, "id long, v long, g long")
    out = ordered_running(df, order="v", sums=["v"], groups=["g"], tiebreak=["id"],
                          ranges=13).collect()
    for r in out:
        prior = [x for x in vals if x[2] == r.g and (x[1], x[0]) <= (r.v, r.id)]
        assert r._rank == len(prior)
        assert r.v_cum == sum(x[1] for x in prior)


def test_stratified_split_exact(spark):
    rows = [(i, 1 if i % 4 == 0 else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, label int")
    out = smp.stratified_split(df, id_cols="id", label_col="label", test_size=0.3, ranges=5)
    counts = {(r.label, r.split): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert counts[(1, "test")] == 75 and counts[(0, "test")] == 225
    again = smp.stratified_split(df, id_cols="id", label_col="label", test_size=0.3, ranges=9)
    a = {r.id for r in out.where("split = 'test'").collect()}
    b = {r.id for r in again.where("split = 'test'").collect()}
    assert a == b


def test_hash_sample_and_limit_repeatable(spark):
    df = spark.range(2000).withColumnRenamed("id", "cid")
    a = {r.cid for r in smp.hash_sample(df, "cid", 0.3).collect()}
    b = {r.cid for r in smp.hash_sample(df.repartition(7), "cid", 0.3).collect()}
    assert a == b and 450 < len(a) < 750
    l1 = [r.cid for r in smp.hash_limit(df, "cid", 10).collect()]
    l2 = [r.cid for r in smp.hash_limit(df.repartition(3), "cid", 10).collect()]
    assert l1 == l2 and len(l1) == 10
    assert {r.cid for r in smp.last_digit_sample(df, "cid").collect()} == \
        {i for i in range(2000) if i % 10 == 1}


def test_auc_of_negated_score(spark):
    rng = random.Random(11)
    labels = [rng.random() < 0.4 for _ in range(200)]
    scores = [round(rng.random(), 2) for _ in labels]
    a = met.roc_auc(frame(spark, labels, scores)).first()[0]
    b = met.roc_auc(frame(spark, labels, [-s for s in scores])).first()[0]
    assert a + b == pytest.approx(1.0, abs=2e-6)


def test_ranges_stay_even_when_half_of_the_rows_tie(spark):
    """Ties are cut by their ids: no range grows with a score's rows."""
    from spendgrid.operators.ranking import RANGE, in_blocks
    from pyspark.sql import functions as F

    rows = spark.range(60_000).select("id", F.when(F.col("id") % 2 == 0, 0.5).otherwise(F.col("id") / 60_000.0).alias("s"),
                                      (F.col("id") % 3 == 0).cast("int").alias("label"))
    blocks = in_blocks(rows, order=F.col("s"), tiebreak=["id"], ranges=100)
    sizes = [r["count"] for r in blocks.groupBy(RANGE).count().collect()]
    assert len(sizes) > 80 and max(sizes) < 3 * 60_000 / 100
    ranked = ordered_running(rows, order="s", tiebreak=["id"], ranges=100)
    from pyspark.sql import Window
    exact = rows.withColumn("r", F.row_number().over(Window.orderBy("s", "id")))
    assert ranked.join(exact, "id").where("_rank != r").count() == 0 and ranked.count() == 60_000


def test_twenty_thousand_ranges(spark):
    from spendgrid.operators.ranking import RANGE, in_blocks
    from pyspark.sql import functions as F

    rows = spark.range(0, 200_000, 1, 4).select("id", F.when(F.col("id") % 2 == 0, 0.5).otherwise(F.rand(1)).alias("s"))
    dealt = rows.repartitionByRange(20_000, "s", "id").select(F.spark_partition_id().alias("p"))
    sizes = [r["count"] for r in dealt.groupBy("p").count().collect()]
    assert len(sizes) > 10_000 and max(sizes) < 200


def test_running_totals_over_batches_and_groups(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(3)
        rows = [(i, rng.choice(["a", "b", None]), rng.randrange(9), rng.choice([None, 1.0, 2.5])) for i in range(200)]
        df = spark.createDataFrame(rows, "id long, g string, v int, x double")
        for ranges in (1, 3):
            got = ordered_running(df, order="v", sums=["x", "v"], groups=["g"], tiebreak=["id"], ranges=ranges).collect()
            assert len(got) == 200
            for r in got:
                upto = [q for q in rows if q[1] == r.g and (q[2], q[0]) <= (r.v, r.id)]
                assert r._rank == len(upto) and r.v_cum == sum(q[2] for q in upto)
                assert r.x_cum == pytest.approx(sum(q[3] or 0 for q in upto))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_coverage_cuts_a_tied_score_by_id(spark):
    labels = [1, 0, 1, 0, 1, 0, 1, 0, 1, 0]
    df = frame(spark, labels, [0.9] + [0.5] * 8 + [0.1])
    assert met.coverage_at(df).first()[0] == pytest.approx(2 / 5)  # ids 0, 1, 2
    assert met.coverage_at(frame(spark, [0] * 10, [0.5] * 10)).first()[0] is None
    assert met.roc_auc(frame(spark, [], [])).first()[0] is None


def test_report_reads_its_input_once(spark):
    """One curve serves all metrics; a plan that fails on a second read shows it."""
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = frame(spark, [0, 1, 0, 1, 1] * 20, [i / 100 for i in range(100)]).mapInArrow(count, "id long, label int, score double")
    rep = {r.metric: r.value for r in met.classifier_report(df).collect()}
    assert len(rep) == 5 and reads.value == 100
