"""Whitening of vectors by principal components, found by spectral divide and conquer with the QDWH iteration.

Components are made integers, so sums are exact. The covariance is added up around an integer centre next to the mean (its
entries are integers too), and the driver gets d * d numbers, d the length of a vector. There the polar factor of the
shifted covariance (dynamically weighted Halley iteration) gives the projector on the eigenvalues above the shift; its range
and the complement are invariant, and each is split again until a block is a multiple of the identity."""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark_io import lean, map_batches
from .vectors import finite, matrix

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
_EPS = np.finfo(np.float64).eps


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by the QDWH iteration (QR steps while the weights are large, then
    Cholesky steps)."""
    n = len(a)
    x = a / np.linalg.norm(a)
    r = np.linalg.qr(x, mode="r")
    flat = np.abs(np.diag(r)).min() <= _EPS
    low = _EPS if flat else min(max(0.9 / np.linalg.norm(np.linalg.solve(r, np.eye(n))), _EPS), 1.0)  # below all singular values
    for _ in range(40):
        square = low * low
        d = (4 * (1 - square) / (square * square)) ** (1 / 3)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        else:
            lower = np.linalg.cholesky(np.eye(n) + wc * x.T @ x)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(low * (wa + wb * square) / (1 + wc * square), 1.0)
        if moved < (4 * _EPS) ** (1 / 3) and 1 - low < 10 * _EPS:
            break
    return x


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces of the eigenvalues above and below a shift; nothing if the matrix is a
    multiple of the identity up to rounding (against the scale of the whole)."""
    n = len(a)
    mean = np.trace(a) / n
    if n == 1 or np.linalg.norm(a - mean * np.eye(n)) <= 4 * n * _EPS * scale:
        return None
    rng = np.random.default_rng(11)
    for shift in (float(np.median(np.diag(a))), mean, mean * (1 + 1e-3) + 1e-3 * np.abs(a).max(), mean * (1 - 1e-3) - 1e-3 * np.abs(a).max()):
        moved = a - shift * np.eye(n)
        if np.linalg.norm(moved) <= 4 * n * _EPS * scale:
            continue
        projector = (polar(moved) + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        basis = projector @ rng.standard_normal((n, k))
        q, _ = np.linalg.qr(projector @ np.linalg.qr(basis)[0], mode="complete")
        if np.linalg.norm(q[:, k:].T @ a @ q[:, :k]) <= 100 * n * _EPS * scale:
            return q[:, :k], q[:, k:]
    return None


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns; the largest entry of each is positive) of a symmetric matrix."""
    n, scale = len(v), float(np.linalg.norm(v))
    done, todo = [], [np.eye(n)]
    while todo:
        basis = todo.pop()
        block = basis.T @ v @ basis
        halves = _split((block + block.T) / 2, scale)
        if halves is None:
            done.append(basis)
        else:
            todo += [basis @ h for h in halves]
    q = np.concatenate(done, axis=1) if done else np.zeros((n, 0))
    e = np.einsum("ij,ij->j", q, v @ q)
    order = np.argsort(-e, kind="stable")
    q = q[:, order]
    return e[order], q * np.where(q[np.abs(q).argmax(axis=0), np.arange(n)] < 0, -1.0, 1.0)


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * c) + OFFSET of each component."""
    if x.size and np.abs(x).max() >= 2.0**62 / SCALE:
        raise OverflowError("a component is too large: floor(64 * c) + 1000000 is no long")
    return np.floor(x * SCALE).astype(np.int64) + OFFSET


def _sums(fine: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows, and the exact sum of each dimension."""

    def run(batches):
        n, total = 0, [0] * d
        for b in batches:
            x = integers(matrix(b.column(0), d))
            high, low = (x >> 32).sum(axis=0).tolist(), (x & (1 << 32) - 1).sum(axis=0).tolist()
            n, total = n + len(x), [t + (h << 32) + i for t, h, i in zip(total, high, low)]
        kinds = (pa.int32(), pa.decimal128(38, 0))
        rows = list(enumerate([n, *total], -1))
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], kinds[0]), pa.array([Decimal(v) for _, v in rows], kinds[1])], names=["at", "value"])

    told = fine.mapInArrow(run, "at int, value decimal(38,0)").groupBy("at").agg(F.sum("value").alias("value")).collect()  # d + 1 numbers
    got = {r["at"]: int(r["value"]) for r in told}
    return got.get(-1, 0), [got.get(i, 0) for i in range(d)]


def _products(fine: DataFrame, d: int, k: int, of) -> np.ndarray:
    """The sum over all rows of the outer product of of(vectors) (k columns): each task adds up its own rows."""

    def run(batches):
        total = np.zeros((k, k))
        for b in batches:
            y = of(matrix(b.column(0), d))
            total += y.T @ y
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "value"])

    out = np.zeros((k, k))
    for r in fine.mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect():  # k * (k + 1) / 2 numbers
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def whiten(vectors: DataFrame) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of each row of vectors (vec_id, embedding) and
    each of the first COMPONENTS principal components.

    Rows whose vector is null or holds null or non-finite components are dropped, and rows of another length than most. Null
    and repeated ids are rows as others; eigenvalues that tie are numbered as they come. A component without variance (below
    rounding) has null for whitened, and takes no part in identity_error, which is null if there is no other; explained is
    null if nothing varies. A deviation too large for a long is null. A component of a vector whose integer does not fit a
    long is an error. Further columns are not looked at; an empty table gives an empty result."""
    fine, d = finite(vectors, "vec_id")
    lean(vectors.sparkSession)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, sums = _sums(fine.select("embedding"), d)
    if not n or not d:
        return vectors.sparkSession.createDataFrame([], schema)
    centre = [round(Fraction(s, n)) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]  # what the centre misses of the mean, times n
    shift, miss = np.array(centre, np.int64), np.array([r / n for r in rest])
    gram = _products(fine.select("embedding"), d, d, lambda x: (integers(x) - shift).astype(np.float64))
    cov = gram / n - np.outer(miss, miss)
    e, q = eigenvectors(cov)
    k = min(COMPONENTS, d)
    e, q, trace = e[:k], q[:, :k], float(np.trace(cov))
    live = e > 4 * d * _EPS * max(float(e[0]), 0.0)
    scaled = q[:, live] / np.sqrt(e[live])
    error = None
    if live.any():
        found = _products(fine.select("embedding"), d, int(live.sum()), lambda x: (integers(x) - shift - miss) @ scaled) / n
        error = float(np.abs(found - np.eye(len(found))).max())
    explained = pa.array([float(v) / trace for v in e] if trace > 0 else [None] * k, pa.float64())
    square, bound = sum(r * r for r in rest), max(abs(r) for r in rest)

    def run(b: pa.RecordBatch):
        x = integers(matrix(b.column(1), d)) - shift
        top = int(np.abs(x).max(initial=0))
        exact = x if max(top, 1) * max(top, bound, 1) * d < 1 << 62 else x.astype(object)  # sums that could pass a long are Python's
        own, cross = (exact * exact).sum(axis=1).tolist(), (exact * np.array(rest, exact.dtype)).sum(axis=1).tolist()
        deviations = [n * n * o - 2 * n * c + square for o, c in zip(own, cross)]
        values = np.full((len(x), k), np.nan)
        values[:, live] = (x - miss) @ scaled
        at = pa.array(np.repeat(np.arange(len(x)), k))
        fits = pa.array([v if v < 1 << 63 else None for v in deviations], pa.int64())
        none = np.tile(~live, len(x))
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(at), n, np.int64)), fits.take(at), pa.array(values.ravel(), mask=none),
             explained.take(pa.array(np.tile(np.arange(k), len(x)))), pa.array([error] * len(at), pa.float64())],
            names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
        )

    return map_batches(fine, run, schema)
