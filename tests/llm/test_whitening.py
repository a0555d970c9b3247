from __future__ import annotations

import numpy as np
import pytest

from spendgrid.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<float>"


def table(spark, m, ids=None):
    ids = range(len(m)) if ids is None else ids
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in zip(ids, m)], SCHEMA).repartition(3)


def expected(m, components):
    x = np.floor(64 * m.astype(np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    off = x - s / n
    v = off.T @ off / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
    return n, ((n * x - s) ** 2).sum(axis=1), off @ axes / np.sqrt(e), e / np.trace(v)


@pytest.mark.parametrize("n, size, components", [(300, 12, 32), (400, 50, 32), (200, 40, 5)])
def test_equals_dense_solution(spark, n, size, components):
    rng = np.random.default_rng(n)
    m = rng.standard_normal((n, size)) * rng.uniform(0.1, 3, size) @ np.linalg.qr(rng.standard_normal((size, size)))[0]
    got = W.whiten(table(spark, m), components).toPandas().sort_values(["vec_id", "component"])
    k = min(size, components)
    count, deviation, whitened, explained = expected(m, k)
    assert len(got) == n * k and (got["n"] == count).all()
    values = got["whitened"].to_numpy().reshape(n, k)
    assert (got["deviation"].to_numpy().reshape(n, k) == deviation[:, None]).all()
    sign = np.sign((values * whitened).sum(axis=0))
    assert np.abs(values - whitened * sign).max() < 1e-8
    assert np.abs(got["explained"].to_numpy()[:k] / explained - 1).max() < 1e-10
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-10


def dense(n, values):
    q = np.linalg.qr(np.random.default_rng(4).standard_normal((n, n)))[0]
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("v, wanted", [
    (np.eye(50), 32), (dense(60, [5.0] * 20 + [3.0] * 20 + [0.0] * 20), 32), (dense(60, [1e6, 10, *(9 + 1e-7 * np.arange(20)), *np.linspace(1, 2, 38)]), 32),
    (np.diag(2.0 ** -np.arange(40)), 32), (np.array([[2.0]]), 32), (dense(300, np.linspace(1, 2, 300) ** 3), 32)])
def test_no_eigenpair_is_missed(v, wanted):
    bound = np.abs(v).sum(axis=1).max()
    form = W.tridiagonal((v + v.T) / 2)
    assert [W.count_above(form, s) for s in (-bound * 1.1, bound * 1.1)] == [len(v), 0]
    pairs = [W.feast(v, *cut) for cut in W.cut_spectrum(form, bound * (1 + 1e-9), wanted, W.ROUNDING * bound)]
    values, axes = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs], axis=1)
    order = np.argsort(-values)[:wanted]
    values, axes = values[order], axes[:, order]
    truth = np.linalg.eigvalsh(v)[::-1]
    truth = truth[truth > W.ROUNDING * bound][:wanted]
    assert len(values) == len(truth) and np.abs(values - truth).max() < 1e-13 * bound
    assert np.abs(v @ axes - axes * values).max() < 1e-12 * bound
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-8


def test_odd_rows(spark):
    rng = np.random.default_rng(8)
    m = rng.standard_normal((40, 4)).astype(np.float32)
    good = [(i, [float(x) for x in row]) for i, row in enumerate(m)]
    bad = [(50, None), (51, [1.0, None, 2.0, 3.0]), (52, [float("nan")] * 4), (53, [float("inf"), 1.0, 1.0, 1.0]), (54, []), (55, [1.0, 2.0])]
    rows = [(i, v, 1.0, "n", 7) for i, v in good + [(None, good[0][1]), (3, good[3][1])] + bad]
    vectors = spark.createDataFrame(rows, SCHEMA + ", n double, v string, component int").repartition(3)
    got = W.whiten(vectors).collect()
    both = np.concatenate([m, m[:1], m[3:4]])
    n, deviation, whitened, _ = expected(both, 4)
    assert len(got) == 4 * 42 and {r["n"] for r in got} == {42} and {r["vec_id"] for r in got} == {*range(40), None}
    ends = sorted((str(r["vec_id"]), r["component"], r["deviation"], round(abs(r["whitened"]), 8)) for r in got)
    ids = [*range(40), None, 3]
    assert ends == sorted((str(ids[i]), k + 1, int(deviation[i]), round(abs(whitened[i, k]), 8)) for i in range(42) for k in range(4))
    assert W.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert W.whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).collect() == []
    assert W.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], SCHEMA)).collect() == []
    one_way = W.whiten(spark.createDataFrame([(i, [float(i), 1.0, 2.0 * i]) for i in range(5)], SCHEMA)).collect()
    assert {r["component"] for r in one_way} == {1}
    wide = W.whiten(spark.createDataFrame([(i, [1e30 * (-1) ** i, float(i)]) for i in range(6)], SCHEMA)).collect()
    assert {r["deviation"] for r in wide} == {None} and all(np.isfinite(r["whitened"]) for r in wide)


def test_commonest_length(spark):
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(10)] + [(100 + i, [float(i), 1.0 * i * i, 2.0]) for i in range(10)] + [(200, [1.0])]
    got = W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"] for r in got} == set(range(100, 110))
