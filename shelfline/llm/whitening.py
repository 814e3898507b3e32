"""Whitening of vectors by the leading eigenvectors of their covariance, with mixed-precision refinement.

Every component becomes the integer ``floor(1024 * c) + 100000``. One pass sums the integers and their extremes, a second one the
products of the integers centred at the rounded mean; blocks are small enough that both are exact, so the covariance is known
as a fraction whatever the order of tasks. Its eigenvectors are found in float32 and corrected by the matrix-multiplication
iteration of Ogita and Aishima in extended precision; eigenvalues closer than the iteration can tell apart form clusters, and a small
eigenproblem within each cluster's subspace separates them. Only dimension x dimension numbers reach the driver.

Defined cases: which rows count is said in ``vectors``; repeated rows count each; integers before the shift are kept within
``BOUND``; a direction without variance gives whitened 0 and explained 0 and is left out of the identity error; a deviation beyond a long
is null; with equal eigenvalues any orthonormal basis of their space is right; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .vectors import blocks, dimension, floors, is_whole

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
BOUND = 1 << 24
#: Partial sums of one key that meet in one task before the last sum.
SALTS = 64
#: A direction with less than this share of the variance counts as one without.
NOTHING = 1e-14
_LIMB = 32


@dataclass
class Moments:
    """Exact first and second moments of the integers."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    """In extended precision."""


def _x(vectors: pa.Array) -> np.ndarray:
    return floors(vectors, SCALE, BOUND) + SHIFT


def _sums(rows: DataFrame, size: int) -> tuple[int, list[int], int, int]:
    """Count, sum per dimension, smallest and largest integer."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, dtype=np.int64)
        low, high = np.full(size, 2 * BOUND), np.full(size, -2 * BOUND)
        for batch in blocks(batches):
            x = _x(batch.column("v"))
            n += len(x)
            total += x.sum(axis=0)
            low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(np.full(size, n)), pa.array(total), pa.array(low), pa.array(high)], names=["i", "n", "s", "low", "high"])

    partial = rows.select("v").mapInArrow(add, "i bigint, n bigint, s bigint, low bigint, high bigint")
    found = partial.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    found.sort(key=lambda r: r["i"])
    return found[0]["n"], [r["s"] for r in found], min(r["low"] for r in found), max(r["high"] for r in found)


def _products(rows: DataFrame, centre: np.ndarray, reach: int) -> list[list[int]]:
    """Exact sums of the products of the centred integers, which are at most ``reach`` from 0.

    A block of float64 products is exact as long as its sum stays below 2 ** 53; sums of blocks are kept in two limbs.
    """
    size = len(centre)
    at_once = max(1, min(4096, (1 << 53) // max(1, reach * reach)))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros((2, size, size), dtype=np.int64)
        seen = False
        for batch in blocks(batches, at_once):
            y = (_x(batch.column("v")) - centre).astype(np.float64)
            block = (y.T @ y).astype(np.int64)
            high += block >> _LIMB
            low += block & ((1 << _LIMB) - 1)
            seen = True
        if seen:
            cells = [pa.FixedSizeListArray.from_arrays(pa.array(a.reshape(-1)), size).cast(pa.list_(pa.int64())) for a in (high, low)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), *cells], names=["i", "high", "low"])

    def add(table: pa.Table) -> pa.Table:
        limbs = [np.asarray(table.column(c).combine_chunks().flatten()).reshape(-1, size).sum(axis=0) for c in ("high", "low")]
        high, low = limbs[0] + (limbs[1] >> _LIMB), limbs[1] & ((1 << _LIMB) - 1)
        cells = [pa.array([a.tolist()], pa.list_(pa.int64())) for a in (high, low)]
        return pa.table([table.column("i").slice(0, 1), *cells], names=["i", "high", "low"])

    kind = "i bigint, high array<bigint>, low array<bigint>"
    partial = rows.select("v").mapInArrow(multiply, kind)
    # One row per task and dimension: they meet in salted groups first, so no group grows with the number of tasks alone.
    salted = partial.groupBy("i", (F.spark_partition_id() % SALTS).alias("salt")).applyInArrow(add, kind)
    rows_of = {r["i"]: r for r in salted.groupBy("i").applyInArrow(add, kind).collect()}
    return [[(h << _LIMB) + lo for h, lo in zip(rows_of[i]["high"], rows_of[i]["low"], strict=True)] for i in range(size)]


def moments(rows: DataFrame, size: int) -> Moments:
    n, sums, low, high = _sums(rows, size)
    centre = [s // n for s in sums]
    reach = max(high - min(centre), max(centre) - low) + 1
    products = _products(rows, np.array(centre, dtype=np.int64), reach)
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    # n * n * V as whole numbers; the division is the only rounding.
    exact = [[n * products[i][j] - rest[i] * rest[j] for j in range(size)] for i in range(size)]
    scale = np.longdouble(n) * np.longdouble(n)
    covariance = np.array([[np.longdouble(str(v)) / scale for v in row] for row in exact], dtype=np.longdouble)
    return Moments(n, sums, covariance)


def _correction(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.longdouble, np.longdouble]:
    """(eigenvalues, correction E of X to X + X E, distance below which eigenvalues cannot be told apart, lack of orthogonality)."""
    r = np.eye(len(a), dtype=np.longdouble) - x.T @ x
    s = x.T @ (a @ x)
    # Symmetric to the last bit, as then E + E^T is R however small a gap is, and the vectors stay orthogonal.
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    blur = 2 * (_norm(s - np.diag(values)) + _norm(a) * _norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > blur
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return values, e, blur, np.abs(r).max()


def _norm(m: np.ndarray) -> np.longdouble:
    return np.sqrt((m * m).sum())


def _clusters(values: np.ndarray, blur: np.longdouble) -> list[np.ndarray]:
    """Groups of two or more neighbouring eigenvalues that lie closer than ``blur``."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > blur) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def eigenvectors(a: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of a symmetric matrix in extended precision.

    A vector is right to about 1e-19 times the matrix norm over the gap to the next eigenvalue. Its largest component is positive.
    """
    a = a.astype(np.longdouble)
    size = _norm(a)
    if not len(a) or size == 0:
        return np.zeros(len(a), dtype=np.longdouble), np.eye(len(a), dtype=np.longdouble)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    eps = np.finfo(np.longdouble).eps
    last = np.inf
    for _ in range(rounds):
        values, e, blur, skew = _correction(a, x)
        x = x + x @ e
        step = np.abs(e).max()
        turned = False
        for group in _clusters(values, blur):
            base = x[:, group]
            # Shifted to the cluster's middle and scaled, a float64 solve tells its members apart.
            inner = base.T @ (a @ base) - np.diag(np.full(len(group), values[group].mean())) @ (base.T @ base)
            inner = (inner + inner.T) / 2
            spread = _norm(inner)
            if spread > 64 * eps * len(a):
                turn = np.linalg.eigh((inner / spread).astype(np.float64))[1]
                turned = turned or bool(np.abs(np.abs(turn).max(axis=0) - 1).max() > 1e-12)
                x[:, group] = base @ turn.astype(np.longdouble)
        # The step ends at the rounding error over the smallest gap.
        if not turned and skew < 16 * eps * len(a) and (step <= 4 * eps or step >= last / 2):
            break
        last = step
    values = _correction(a, x)[0]
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    signs = np.where(x[np.abs(x).argmax(axis=0), np.arange(len(a))] < 0, -1, 1)
    return values[order] * size, x * signs


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector that counts and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    kind = vectors.schema[vec_id].dataType.simpleString()
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v")).filter(is_whole("v"))
    size = dimension(rows, "vec_id", "v")
    rows = rows.filter(F.size("v") == size)
    if not size:
        return _output(rows.select("vec_id", F.lit(0).cast("bigint").alias("deviation"), F.array(F.lit(0.0)).alias("w")).limit(0), 0, [0.0], 0.0)
    found = moments(rows, size)
    values, bases = eigenvectors(found.covariance)
    total = np.trace(found.covariance)
    k = min(components, size)
    real = values[:k] > NOTHING * total
    directions = np.where(real, bases[:, :k] / np.sqrt(np.where(real, values[:k], 1)), 0)
    n, sums = found.n, np.array(found.sums, dtype=np.int64)
    centre = sums // n
    rest = (sums - n * centre).astype(np.longdouble) / n
    matrix, offset = directions.astype(np.float64), (rest @ directions).astype(np.float64)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            x = _x(batch.column("v"))
            off = n * x - sums
            about = (off.astype(np.float64) ** 2).sum(axis=1)
            deviation = pa.array((off * off).sum(axis=1), mask=about > 9.2e18)
            w = (x - centre).astype(np.float64) @ matrix - offset
            cells = pa.FixedSizeListArray.from_arrays(pa.array(w.reshape(-1)), k).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, cells], names=["vec_id", "deviation", "w"])

    projected = materialize(rows.mapInArrow(project, f"vec_id {kind}, deviation bigint, w array<double>"), "whitened")
    pairs = [(i, j) for i in range(k) for j in range(i, k) if real[i] and real[j]]
    measured = projected.agg(F.lit(0.0), *[F.covar_pop(F.col("w")[i], F.col("w")[j]) for i, j in pairs]).first()[1:]
    error = max((abs(c - (i == j)) for c, (i, j) in zip(measured, pairs, strict=True)), default=0.0)
    explained = [float(v / total) if r else 0.0 for v, r in zip(values[:k], real, strict=True)]
    return _output(projected, n, explained, error)


def _output(projected: DataFrame, n: int, explained: list[float], error: float) -> DataFrame:
    shares = F.array(*[F.lit(x) for x in explained])
    long = projected.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return long.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        shares[F.col("at")].alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
