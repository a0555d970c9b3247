"""Search, early stop, and categories of any number."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendgrid.operators import model as ml
from spendgrid.operators.encoding import OrderedTargetEncoder, Vocabulary
from spendgrid.operators.sampling import id_hash, row_id
from spendgrid.operators.search import Parzen, maximise, random_draw

SPACE = {"learning_rate": (0.01, 0.5), "num_trees": (50, 500), "l2_leaf_reg": (1, 10), "depth": (2, 6)}


def surface(p):
    return -((math.log(p["learning_rate"]) - math.log(0.08)) ** 2 + ((p["num_trees"] - 320) / 150) ** 2
             + ((p["l2_leaf_reg"] - 4) / 4) ** 2 + ((p["depth"] - 4) / 2) ** 2)


def test_search_beats_random_draws():
    better = 0
    for seed in range(20):
        _, found, trials = maximise(surface, SPACE, max_evals=60, seed=seed)
        rng = random.Random(1000 + seed)
        better += found > max(surface(random_draw(SPACE, rng)) for _ in range(60))
        assert len(trials) == 60
        for p, _ in trials:
            assert all(a <= p[k] <= b for k, (a, b) in SPACE.items())
            assert all(isinstance(p[k], int) for k in ("num_trees", "l2_leaf_reg", "depth"))
    assert better >= 16


def test_search_is_seeded_and_parallel():
    a = maximise(surface, SPACE, max_evals=20, seed=3, parallelism=4)
    assert a == maximise(surface, SPACE, max_evals=20, seed=3, parallelism=4)
    assert a != maximise(surface, SPACE, max_evals=20, seed=4, parallelism=4)
    points = [tuple(p.values()) for p, _ in a[2]]
    assert len(set(points)) == 20


def test_parzen_is_a_density():
    p = Parzen(0.0, 2.0, [0.1, 0.15, 1.9])
    xs = np.linspace(0, 2, 4001)
    assert np.trapezoid([math.exp(p.log_density(x)) for x in xs], xs) == pytest.approx(1, abs=1e-3)
    q = Parzen(1, 9, [2, 2, 8])
    assert sum(math.exp(q.log_density(k)) for k in range(1, 10)) == pytest.approx(1, abs=1e-6)


def test_best_round():
    assert ml.best_round([5, 4, 3, 4, 5, 6], 3) == (3, True)
    assert ml.best_round([5, 4, 3, 4, 5, 2], 4) == (6, False)
    assert ml.best_round([5, 4, 3, 4, 5, 6, 1], 3) == (3, True)


def noisy(spark, n=600):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        x = float(rng.normal())
        rows.append((i, int(rng.random() < 1 / (1 + math.exp(-1.5 * x))), x, float(rng.normal()), i % 3 == 0))
    return spark.createDataFrame(rows, "id long, label int, x double, z double, is_valid boolean")


def test_trees_after_the_best_are_gone(spark):
    df = noisy(spark)
    params = ml.TreeParams(learning_rate=0.4, num_trees=60, depth=4)
    model = ml.fit(df, [], ["x", "z"], params, "label", "is_valid", ["id"], patience=6)
    best, seen = ml.best_round(model.losses, 6)
    assert seen and model.trees.getNumTrees == best < len(model.losses) <= 24
    assert min(model.losses) == model.losses[best - 1]
    # the same first trees, whatever number was asked for
    whole = ml.fit(df.where("not is_valid"), [], ["x", "z"], ml.TreeParams(0.4, best, 4))
    a = {r["id"]: r["p"] for r in ml.predict(model, df, "p", ["id"]).collect()}
    b = {r["id"]: r["p"] for r in ml.predict(whole, df, "p", ["id"]).collect()}
    assert a == pytest.approx(b)


def test_ordered_means_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", "c", None, f"v{i}"]), rng.randrange(2)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, c string, label int")
    enc = OrderedTargetEncoder(["c"], "label", ["id"], blocks=5)
    got = {r["id"]: r["c__mean"] for r in enc.fit_transform(df).collect()}
    block = {r["id"]: r["b"] for r in df.select("id", (id_hash(row_id("id"), "order") % 5).alias("b")).collect()}
    prior = sum(r[2] for r in rows) / 300
    for i, c, _ in rows:
        before = [y for j, d, y in rows if d == c and block[j] < block[i]]
        assert got[i] == pytest.approx((sum(before) + prior) / (len(before) + 1))
    other = spark.createDataFrame([(1, "a"), (2, None), (3, "new")], "id long, c string")
    code = {r["id"]: r["c__mean"] for r in enc.transform(other).collect()}
    for i, c in ((1, "a"), (2, None)):
        ys = [y for _, d, y in rows if d == c]
        assert code[i] == pytest.approx((sum(ys) + prior) / (len(ys) + 1))
    assert code[3] == pytest.approx(prior)


def test_hundred_thousand_categories(spark):
    df = spark.range(0, 200_000, 1, 4).select(
        "id", F.concat(F.lit("city"), (F.col("id") % 100_000).cast("string")).alias("city"), (F.col("id") % 7).cast("double").alias("x"))
    df = df.withColumn("label", (F.xxhash64("city") % 4 == 0).cast("int"))
    assert ml.large_categories(df, ["city"]) == ["city"]
    model = ml.fit(df, ["city"], ["x"], ml.TreeParams(num_trees=2, depth=2), id_cols=["id"])
    assert model.trees.getMaxBins() == ml.BINS
    scored = ml.predict(model, df, "p", ["id", "label"])
    mean = {r["label"]: r["avg(p)"] for r in scored.groupBy("label").avg("p").collect()}
    assert scored.count() == 200_000 and mean[1] > mean[0] + 0.2


def test_vocabulary_is_a_table(spark):
    train = spark.createDataFrame([("b", "x"), ("a", None), ("a", "y"), ("b", "x")], "c string, d string")
    words = Vocabulary(["d", "c"]).fit(train)
    assert sorted((r["column"], r["value"], r["number"]) for r in words.table.collect()) == [
        ("c", "a", 0), ("c", "b", 1), ("d", "x", 2), ("d", "y", 3)]
    rows = spark.createDataFrame([(1, "a", "y"), (2, "z", None), (3, "b", "new")], "id int, c string, d string")
    got = {r["id"]: (r["indices"], r["size"]) for r in words.transform(rows, ["id"]).collect()}
    assert got == {1: ([0, 3], 4), 2: ([], 4), 3: ([1], 4)}
    many = spark.range(50_000).select(F.col("id").cast("string").alias("c"), F.lit("k").alias("d"))
    big = Vocabulary(["c", "d"]).fit(many)
    row = big.table.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()
    assert tuple(row) == (0, 50_000, 50_001) and big.size == 50_001
