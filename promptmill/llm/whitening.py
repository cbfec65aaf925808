"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become whole numbers (the floor of 256 times each entry), and every distinct one is a row
of the fit table X, centred by the exact sums. The bidiagonalisation alternates products with X
and its transpose: ``alpha_k u_k = X v_k - beta_(k-1) u_(k-1)`` and
``beta_k v_(k+1) = X' u_k - alpha_k v_k``. A left vector has an entry for each row of the table,
so it is never held: it is X times a vector of the table's width, kept on the driver beside the
right vectors, and one pass over the table makes both products. Both sides are made orthogonal to
all earlier vectors, twice. After as many steps as there are dimensions, the small bidiagonal
matrix has the singular values of X, and the right vectors turned by its own right vectors are the
components; fewer steps may be asked for. Where a product vanishes (a rank below the width, equal
eigenvalues) the next right vector starts anew, at right angles to all earlier ones.

What reaches the driver in a pass is one number for each dimension. A vector that occurs very
often is one row of the fit table, by partial aggregation.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are dropped; a
vector shorter than the longest one is filled with zeros at its end; entries beyond the long range
end at its limits; null identifiers and repeated rows are rows of the result; components with an
eigenvalue of no more than 10^-12 of the largest are no components, so a single distinct vector has
none and an empty table gives an empty one; a deviation beyond the long range is null; extra
columns do not reach the result.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE = 256.0
COMPONENTS = 4
RANK_SHARE = 1e-12       # of the largest eigenvalue
LOST = 1e-13             # a product this small against the largest so far has vanished
ROWS = 8_192
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whole_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and the vector in whole numbers, filled up to the longest."""
    entry = F.col(vector)
    fine = F.coalesce(F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c)
                               & (F.abs(c) < F.lit(float("inf")))), F.lit(False))
    rows = table.where(fine).select(
        F.col(key).cast("long").alias("vec_id"),
        F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))
    width, least = rows.agg(F.max(F.size("x")), F.min(F.size("x"))).first()
    if width != least:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(
            F.lit(0).cast("long"), F.lit(width) - F.size("x"))))
    return rows


# ---- passes over the fit table -----------------------------------------------------------------

def _matrices(batches, column: int = 0):
    """The vectors of a batch as rows of a matrix of whole numbers, with their batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            rows = batch.slice(at, ROWS)
            yield rows, rows.column(column).flatten().to_numpy().reshape(rows.num_rows, -1)


def _exact_sums(batches):
    total = None
    for _, x in _matrices(batches):
        some = x.sum(axis=0, dtype=object) if np.abs(x.astype(float)).max(initial=0) > 2 ** 48 \
            else x.sum(axis=0).astype(object)
        total = some if total is None else total + some
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()),
             pa.array([str(int(v)) for v in total], pa.string())], ["dim", "value"])


def column_sums(fit: DataFrame) -> list:
    """The exact sum of every dimension."""
    parts = fit.select("x").mapInArrow(_exact_sums, "dim int, value string")
    rows = parts.groupBy("dim").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    return [int(r["value"]) for r in rows.orderBy("dim").collect()]


def summed(fit: DataFrame, mean: np.ndarray, function) -> np.ndarray:
    """The sum over all centred rows of what a function gives for a block of them."""
    def run(batches):
        total = None
        for _, x in _matrices(batches):
            some = function(x - mean)
            total = some if total is None else total + some
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())],
                ["dim", "value"])
    rows = (fit.select("x").mapInArrow(run, "dim int, value double")
            .groupBy("dim").agg(F.sum("value").alias("value")).collect())
    out = np.zeros(len(rows))
    out[[r["dim"] for r in rows]] = [r["value"] for r in rows]
    return out


# ---- bidiagonalisation ---------------------------------------------------------------------

def bidiagonal(multiply, width: int, steps: int | None = None, seed: int = 17):
    """Right vectors (rows), diagonal, superdiagonal, and the vectors whose product with X are the
    left vectors (rows). ``multiply`` gives X'(X p) for a vector p."""
    steps = min(steps or width, width)
    rng = np.random.default_rng(seed)
    right, left, crossed = [], [], []      # v_k, w_k with u_k = X w_k, and X'u_k
    alphas, betas, largest = [], [], 0.0

    def orthogonal(v):
        for _ in range(2):
            for other in right:
                v = v - (other @ v) * other
        return v

    def fresh():
        v = orthogonal(rng.standard_normal(width))
        return v / np.linalg.norm(v)

    v, beta = fresh(), 0.0
    for _ in range(steps):
        p = v - beta * left[-1] if beta else v
        z = multiply(p)                    # X'(X p); with X p the new left vector before scaling
        for again in range(2):
            shares = [w @ z for w in left]     # u_i'(X p)
            for share, w, c in zip(shares, left, crossed):
                p, z = p - share * w, z - share * c
        alpha = np.sqrt(max(0.0, p @ z))
        largest = max(largest, alpha)
        right.append(v)
        alphas.append(alpha if alpha > LOST * largest else 0.0)
        if alphas[-1]:
            left.append(p / alpha)
            crossed.append(z / alpha)
            ahead = orthogonal(crossed[-1] - alpha * v)
            beta = float(np.linalg.norm(ahead))
        else:
            left.append(np.zeros(width))
            crossed.append(np.zeros(width))
            beta = 0.0
        largest = max(largest, beta)
        if beta <= LOST * largest:
            beta = 0.0
        betas.append(beta)
        if len(right) < steps:
            v = ahead / beta if beta else fresh()
            v = orthogonal(v)
            v = v / np.linalg.norm(v)
    return np.array(right), np.array(alphas), np.array(betas[:-1]), np.array(left)


@dataclass(frozen=True)
class Fit:
    n: int
    sums: list                 # exact, for each dimension
    mean: np.ndarray
    values: np.ndarray         # eigenvalues of the components, falling
    components: np.ndarray     # unit rows
    trace: float
    identity_error: float


def fitted(fit: DataFrame, count: int = COMPONENTS, steps: int | None = None) -> Fit | None:
    """Means, components and how far the whitened fit rows are from unit covariance."""
    n = fit.count()
    sums = column_sums(fit) if n else []
    if not sums:
        return None
    mean = np.array([s / n for s in sums])
    right, alphas, betas, _ = bidiagonal(
        lambda p: summed(fit, mean, lambda x: x.T @ (x @ p)), len(sums), steps)
    _, singular, turned = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
    values = singular ** 2 / n
    kept = min(count, int((values > RANK_SHARE * values[0]).sum()))
    components = turned[:kept] @ right
    components /= np.linalg.norm(components, axis=1, keepdims=True)
    trace = float(summed(fit, mean, lambda x: np.array([(x * x).sum()]))[0]) / n
    if not kept:
        return Fit(n, sums, mean, values[:0], components, trace, 0.0)
    turn = (components / np.sqrt(values[:kept, None])).T
    middle = summed(fit, mean, lambda x: (x @ turn).sum(axis=0)) / n

    def square(x):
        y = x @ turn - middle
        return (y.T @ y).ravel()

    spread = summed(fit, mean, square).reshape(kept, kept) / n
    error = float(np.abs(spread - np.eye(kept)).max())
    return Fit(n, sums, mean, values[:kept], components, trace, error)


# ---- rows of the result -----------------------------------------------------------------------

def deviations(x: np.ndarray, n: int, sums) -> list:
    """The exact sum over dimensions of (n*x - sum)^2; None beyond the long range."""
    far = float(np.abs(x.astype(float)).max(initial=0)) * n + max(map(abs, sums), default=0)
    if far < 2 ** 52 and far * far * x.shape[1] < 2 ** 62:
        away = x * n - np.array(sums, np.int64)
        return (away * away).sum(axis=1).tolist()
    away = x.astype(object) * n - np.array(sums, object)
    return [int(v) if v < 1 << 63 else None for v in (away * away).sum(axis=1)]


def _whiten(fit: Fit):
    def run(batches):
        turn = (fit.components / np.sqrt(fit.values[:, None])).T
        k = turn.shape[1]
        explained = fit.values / fit.trace
        for rows, x in _matrices(batches, 1):
            away = deviations(x, fit.n, fit.sums)
            m = rows.num_rows
            yield pa.RecordBatch.from_arrays([
                rows.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, fit.n)),
                pa.array([v for v in away for _ in range(k)], pa.int64()),
                pa.array(((x - fit.mean) @ turn).ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, fit.identity_error))],
                [c.split()[0] for c in RESULT.split(", ")])
    return run


def whitened(table: DataFrame, key: str = "vec_id", vector: str = "embedding",
             count: int = COMPONENTS, steps: int | None = None) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained,
    identity_error."""
    rows = whole_vectors(table, key, vector)
    fit = fitted(written(rows.select("x").distinct(), "fit-vectors"), count, steps)
    if fit is None or not len(fit.values):
        return rows.sparkSession.createDataFrame([], RESULT)
    return rows.mapInArrow(_whiten(fit), RESULT)
