"""Whitening of embeddings by FEAST contour integration.

Two passes over the vectors give the exact sums and the covariance of the
integer grid ``x = floor(64 * entry) + 1000000``, centred before it is
multiplied. Its leading eigenpairs come from the spectrum cut into intervals:

* Inertia: the signs of the pivots of ``T - s`` for the tridiagonal form ``T``
  of the covariance count its eigenvalues above ``s`` (Sylvester, Sturm).
  Bisection on these counts finds where the wanted part begins and cuts it
  into intervals of at most ``MOST`` eigenvalues.
* FEAST: on each interval, a circle through its ends; eight-point
  Gauss-Legendre quadrature of the solves ``(z - V) X = Y`` along it filters a
  block of vectors to the interval's eigenspace, and Rayleigh-Ritz extracts the
  pairs. It repeats until all residuals are at rounding level.
* Every interval must then hold exactly the number of pairs that the inertia
  counts say, or the block grows and the interval is solved again.

Intervals are rows of a Spark job, solved side by side. The covariance
(dimensions squared, whatever the number of rows) is all that is sent round.

A last pass measures the covariance of the whitened rows themselves.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries are dropped, as are those whose length is not the commonest one (the
longer of equally common ones); repeated rows and null ids are rows like
others; eigenvalues not above rounding (1e-12 of the largest) have no component, as one
cannot be divided by their root, so fewer than ``components`` may come back and
none for equal vectors; in an eigenspace of several dimensions the basis is
arbitrary but the same for all rows; entries beyond 2**30 count as that;
``deviation`` is null where it does not fit a long; other columns do not
matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid.llm.common import Scratch, read_table

COMPONENTS = 32
MOST = 8          # eigenvalues of an interval
POINTS = 8        # of the half circle
SCALE, SHIFT, LARGEST = 64.0, 1_000_000, 2.0**30
ROUNDING = 1e-12  # of the largest: no eigenvalue
TIE = 1e-11       # of the largest: not told apart


# --- spectrum of a symmetric matrix -----------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to ``a``."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k]
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        v /= np.linalg.norm(v)
        a[k + 1:] -= 2 * np.outer(v, v @ a[k + 1:])
        a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """How many eigenvalues lie above ``shift``: positive pivots of ``T - shift``."""
    diagonal, off = form
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    found, pivot = 0, 1.0
    for k, d in enumerate(diagonal):
        pivot = d - shift - (off[k - 1] ** 2 / pivot if k else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        found += bool(pivot > 0)
    return found


def cut_spectrum(form: tuple[np.ndarray, np.ndarray], bound: float, wanted: int, floor: float, most: int = MOST) -> list[tuple[float, float, int]]:
    """Intervals (low, high, number of eigenvalues), from the top, that hold the
    ``wanted`` largest eigenvalues above ``floor`` and those equal to the last.
    No interval holds more than ``most``, but for eigenvalues that rounding
    does not tell apart."""
    tie = TIE * bound
    above = lambda s: count_above(form, s)

    def place(goal: int, low: float, high: float) -> float:
        """The greatest shift, up to a tie, with ``goal`` eigenvalues above it."""
        while high - low > tie:
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= goal else (low, middle)
        return low

    wanted = min(wanted, above(floor))
    if not wanted:
        return []
    low = place(wanted, floor, bound)
    while above(low) < above(floor):  # below it: the middle of a gap that is no tie
        below = place(above(low) + 1, floor, low) + tie
        if low - below > 2 * tie:
            low = (low + below) / 2
            break
        low = max(floor, below - 2 * tie)
    top = place(1, low, bound) + 2 * tie
    out, open_ = [], [(low, top, above(low), 0)]
    while open_:
        a, b, n_a, n_b = open_.pop()
        if n_a - n_b <= most or b - a <= 64 * tie:
            if n_a > n_b:
                out.append((float(a), float(b), n_a - n_b))
            continue
        # a cut near the middle, as far from any eigenvalue as can be found
        margin, cut = (b - a) / 16, None
        while cut is None and margin > 4 * tie:
            cut = next((s for s in a + (b - a) * np.array([0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7])
                        if above(s - margin) == above(s + margin)), None)
            margin /= 2
        if cut is None:
            out.append((float(a), float(b), n_a - n_b))
            continue
        n = above(cut)
        open_ += [(a, cut, n_a, n), (cut, b, n, n_b)]
    return out


def feast(v: np.ndarray, low: float, high: float, count: int, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``v`` with values in (low, high]."""
    n = len(v)
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    centre, radius = (low + high) / 2, (high - low) / 2
    turn = np.exp(1j * np.pi / 2 * (nodes + 1))
    inverses = [np.linalg.inv((centre + radius * z) * np.eye(n) - v) for z in turn]
    scale = np.abs(v).sum(axis=1).max()
    rng = np.random.default_rng(11)
    size = min(n, count + max(8, count))
    while True:
        block, settled = rng.standard_normal((n, size)), 0
        for _ in range(rounds):
            filtered = sum(w * radius * (z * (inverse @ block)).real for z, w, inverse in zip(turn, weights, inverses)) / 2
            q, r = np.linalg.qr(filtered)
            kept = np.abs(np.diag(r)) > 1e-14 * np.abs(np.diag(r)).max()
            q = q[:, kept]
            values, small = np.linalg.eigh(q.T @ v @ q)
            block = q @ small
            inside = (values > low) & (values <= high)
            residual = np.linalg.norm(v @ block[:, inside] - block[:, inside] * values[inside], axis=0)
            settled = settled + 1 if inside.sum() == count and (residual <= 1e-14 * max(10, n) * scale).all() else 0
            if settled == 3:  # two more rounds take what is left to rounding
                return values[inside], block[:, inside]
        if size == n:
            raise ArithmeticError(f"{inside.sum()} of {count} eigenvalues in ({low}, {high}]")
        size = min(n, 2 * size)


def leading_pairs(spark: SparkSession, v: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and their vectors (columns), at most
    ``components``, of the covariance ``v``; intervals are solved by Spark tasks."""
    bound = np.abs(v).sum(axis=1).max()
    if not bound > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    form = tridiagonal(v)
    cuts = cut_spectrum(form, bound * (1 + 1e-9), components, ROUNDING * bound)
    sent = spark.sparkContext.broadcast(v)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, count in zip(*(c.to_pylist() for c in batch.columns)):
                values, vectors = feast(sent.value, low, high, count)
                yield pa.RecordBatch.from_arrays([
                    pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], names=["value", "vector"])

    rows = spark.createDataFrame([(float(a), float(b), int(k)) for a, b, k in cuts], "low double, high double, count int")
    pairs = rows.repartition(len(cuts)).mapInArrow(solve, "value double, vector array<double>").collect()
    pairs.sort(key=lambda r: -r["value"])
    values = np.array([r["value"] for r in pairs[:components]])
    vectors = np.array([r["vector"] for r in pairs[:components]]).T
    kept = values > ROUNDING * bound
    return values[kept], vectors[:, kept]


# --- passes over the vectors ---------------------------------------------------------

def _grid(column: pa.Array) -> np.ndarray:
    """x of a batch of clean vectors of one length."""
    if not len(column):
        return np.zeros((0, 0), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * np.clip(flat, -LARGEST, LARGEST)).astype(np.int64).reshape(len(column), -1) + SHIFT


def clean_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, v`` with whole vectors of finite entries."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.select("vec_id", v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0)).where(fine)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and sums of a task's vectors, by length."""
    found: dict[int, list] = {}
    for batch in batches:
        sizes = pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            x = _grid(batch.column(0).filter(pa.array(sizes == size)))
            n, s = found.get(size, (0, 0))
            found[size] = (n + len(x), s + x.sum(axis=0))
    for size, (n, s) in found.items():
        yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([n], pa.int64()), pa.array([s.tolist()], pa.list_(pa.int64()))],
                                         names=["size", "n", "s"])


def totals(clean: DataFrame) -> tuple[int, list[int]]:
    """``n`` and ``S`` over the vectors of the commonest length; (0, []) if none."""
    own = clean.select("v").mapInArrow(_totals, "size int, n bigint, s array<bigint>")
    by_size = own.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if by_size is None:
        return 0, []
    sums = own.where(F.col("size") == by_size["size"]).select(F.posexplode("s").alias("at", "s")).groupBy("at").agg(
        F.sum("s").alias("s")).orderBy("at").collect()
    return by_size["n"], [r["s"] for r in sums]


def _products(of: Callable[[np.ndarray], np.ndarray], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = of(_grid(batch.column(0)))
            if len(y):
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])
    return run


def _added(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size)
        for batch in batches:
            for m in batch.column(0).to_pylist():
                total += np.frombuffer(m)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])
    return run


def products(fit: DataFrame, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over all vectors of the outer products of ``of(x)``: one matrix a
    task, added up in at most 64 tasks and then here."""
    own = fit.select("v").mapInArrow(_products(of, size), "m binary")
    own = own.withColumn("to", F.pmod(F.xxhash64("m"), F.lit(64))).repartition(64, "to").select("m")
    return sum(np.frombuffer(r["m"]).reshape(size, size) for r in own.mapInArrow(_added(size), "m binary").collect())


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list:
    """Sums of (n*x - S)**2, exact; null beyond a long."""
    off = n * x.astype(object) - sums.astype(object) if n * (2 * LARGEST * SCALE) * 2 >= 2.0**63 else n * x - sums
    if off.dtype != object and len(off) and float(np.abs(off).max()) ** 2 * off.shape[1] < 2.0**62:
        return (off * off).sum(axis=1).tolist()
    exact = [(sum(int(y) * int(y) for y in row)) for row in off]
    return [d if d < 2**63 else None for d in exact]


def whiten(vectors: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``:
    a row for each clean vector and component."""
    spark = vectors.sparkSession
    clean = Scratch(spark, "whitening").write(clean_vectors(vectors, vector), "clean")
    n, sums = totals(clean)
    schema = "vec_id {}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double".format(
        clean.schema["vec_id"].dataType.simpleString())
    if not n:
        return spark.createDataFrame([], schema)
    size, whole = len(sums), np.array(sums)
    mean = np.array([s / n for s in sums])  # Python divides integers with one rounding
    near, rest = np.rint(mean).astype(np.int64), None
    rest = np.array([(s - n * int(k)) / n for s, k in zip(sums, near)])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - near) - rest  # whole part first: no digits are lost

    fit = clean.where(F.size("v") == size)
    covariance = products(fit, centred, size) / n
    values, axes = leading_pairs(spark, covariance, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    basis = axes / np.sqrt(values)
    spread = products(fit, lambda x: centred(x) @ basis, len(values)) / n
    error = float(np.abs(spread - np.eye(len(values))).max())
    explained = values / np.trace(covariance)
    k = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = _grid(part.column(1))
                m = len(x)
                if not m:
                    continue
                ids = part.column(0).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, dtype=np.int64)),
                    pa.array(_deviation(x, n, whole), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array((centred(x) @ basis).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return fit.select("vec_id", "v").mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))
