"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are never multiplied with their own transpose. Each step takes one distributed product
y = Xq and, in the same pass, X'y: a task works block by block and gives a vector of the length of an
embedding. With X V = U B for an upper bidiagonal B,

    alpha_j u_j = X v_j - beta_(j-1) u_(j-1)        beta_j v_(j+1) = X' u_j - alpha_j v_j

and as u_j lies in the span of X's columns, u_j = X p_j: the driver holds p_j and X' u_j, two short vectors
per step, and from them orthogonalises new vectors in full, u against all former u (their products are
p_i' X' y) as well as v against all former v. The singular values and right vectors of the small B give
the components and deviations. Steps go on until the wanted components have converged and what the
steps have not reached of the total variance is too small to hide a larger one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

COMPONENTS = 4
SCALE = 256
BLOCK_ROWS = 4096
SEED = 7
TOLERANCE = 1e-14
LONG = 1 << 63
BLOCK = "rows int, wide boolean, cells binary"
CELL = "place int, value double"
OUT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


class Whitening(NamedTuple):
    """What whitens vectors: sums and number of the fit list, components as rows, their eigenvalues,
    the trace of the covariance, and the largest entry of whitened's covariance minus the identity."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def scaled(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x): entries times ``SCALE``, rounded down, of the rows whose vector is whole and finite and
    of the commonest length, the longest of those."""
    odd = F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = vectors.where(F.col(column).isNotNull()).where(~odd).select("vec_id", F.col(column).alias("raw"))
    common = whole.groupBy(F.size("raw").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    whole = whole.where(F.size("raw") == (common.size if common else 0))
    return whole.select("vec_id", F.transform("raw", lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def blocks_of(fit: DataFrame, width: int) -> DataFrame:
    """The rows ``x`` as matrices of up to ``BLOCK_ROWS`` rows, of 32-bit numbers where they fit."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows: np.ndarray) -> pa.RecordBatch:
            wide = bool(len(rows)) and (rows.max() > np.iinfo(np.int32).max or rows.min() < np.iinfo(np.int32).min)
            cells = rows.astype(np.int64 if wide else np.int32).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([len(rows)], pa.int32()), pa.array([bool(wide)]), pa.array([cells], pa.binary())],
                ["rows", "wide", "cells"],
            )

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(_matrix(batch.column(0), width))
            if sum(map(len, held)) >= BLOCK_ROWS:
                rows = np.concatenate(held)
                for at in range(0, len(rows) - BLOCK_ROWS + 1, BLOCK_ROWS):
                    yield block(rows[at : at + BLOCK_ROWS])
                held = [rows[len(rows) - len(rows) % BLOCK_ROWS :]]
        if sum(map(len, held)):
            yield block(np.concatenate(held))

    return fit.mapInArrow(make, BLOCK)


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for wide, cells in zip(batch.column("wide").to_pylist(), batch.column("cells")):
            yield np.frombuffer(cells.as_buffer(), dtype=np.int64 if wide else np.int32).reshape(-1, width)


def exact_sums(blocks: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums of their columns."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Halves of 32 bits, so that no sum of a block overflows.
        low, high = [0] * width, [0] * width
        for rows in _matrices(batches, width):
            rows = rows.astype(np.int64)
            low = [a + b for a, b in zip(low, (rows & 0xFFFFFFFF).sum(axis=0).tolist())]
            high = [a + b for a, b in zip(high, (rows >> 32).sum(axis=0).tolist())]
        sums = [a + (b << 32) for a, b in zip(low, high)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(sums, pa.decimal128(38))], ["place", "value"]
        )

    parts = blocks.mapInArrow(add, "place int, value decimal(38,0)").groupBy("place").agg(F.sum("value").alias("value"))
    sums = {row.place: int(row.value) for row in parts.collect()}
    n = blocks.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return n, [sums.get(k, 0) for k in range(width)]


def summed(blocks: DataFrame, width: int, mean: np.ndarray, part) -> np.ndarray:
    """Sum over all blocks of ``part(centred rows)``, a vector; one pass."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for rows in _matrices(batches, width):
            own = part(rows - mean)
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["place", "value"])

    parts = blocks.mapInArrow(add, CELL).groupBy("place").agg(F.sum("value").alias("value")).collect()
    return np.array([row.value for row in sorted(parts, key=lambda row: row.place)])


def orthogonal(x: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``x`` without its parts along the orthonormal basis; twice is enough."""
    if basis:
        base = np.array(basis)
        for _ in range(2):
            x = x - base.T @ (base @ x)
    return x


def bidiagonal(multiply, width: int, variance: float, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest singular values (falling) and right singular vectors (rows) of X, ``wanted`` or as many as its
    rank allows. ``multiply(q)`` gives X'Xq and the squared length of Xq by one pass; ``variance`` is the
    squared Frobenius norm of X."""
    rng = np.random.default_rng(SEED)
    start = rng.standard_normal(width)
    v = [start / np.linalg.norm(start)]
    p, g, alphas, betas = [], [], [], []
    scale, reached = math.sqrt(variance), 0.0
    while True:
        q = v[-1] - betas[-1] * p[-1] if betas else v[-1]
        back, squared = multiply(q)
        # Xq without its parts along the former u = Xp, whose products with it are p'X'Xq.
        along = [float(held @ back) for held in p]
        for part, held, image in zip(along, p, g):
            q, back, squared = q - part * held, back - part * image, squared - part * part
        alpha = math.sqrt(max(squared, 0.0))
        if alpha > TOLERANCE * scale:
            p.append(q / alpha)
            g.append(back / alpha)
        else:
            alpha = 0.0
            p.append(np.zeros(width))
            g.append(np.zeros(width))
        alphas.append(alpha)
        reached += alpha * alpha
        following = orthogonal(g[-1] - alpha * v[-1], v)
        beta = float(np.linalg.norm(following))
        small = np.diag(alphas) + np.diag(betas, 1)
        left, values, right = np.linalg.svd(small)
        top = min(wanted, len(values))
        last_residual = beta * np.abs(left[-1, :top]).max()
        hidden = variance - reached - beta * beta
        done = top == wanted and last_residual <= TOLERANCE * scale and hidden <= values[top - 1] ** 2
        if done or len(v) == width:
            return values[:top], (right @ np.array(v))[:top]
        if beta <= TOLERANCE * scale:
            # An invariant subspace: go on in what it has not reached.
            beta, following = 0.0, orthogonal(rng.standard_normal(width), v)
            following = orthogonal(following / np.linalg.norm(following), v)
            following /= np.linalg.norm(following)
        else:
            following = orthogonal(following / beta, v)
            following /= np.linalg.norm(following)
        betas.append(beta)
        reached += beta * beta
        v.append(following)


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fitted on each distinct ``x`` once; None without rows."""
    first = rows.select(F.size("x").alias("width")).first()
    if first is None or first.width < 1:
        return None
    width = first.width
    blocks = stored(blocks_of(rows.select("x").distinct(), width), "blocks")
    n, sums = exact_sums(blocks, width)
    mean = np.array([s / n for s in sums])
    variance = float(summed(blocks, width, mean, lambda c: np.array([np.einsum("ij,ij->", c, c)]))[0])
    none = Whitening(n, sums, np.zeros((0, width)), np.zeros(0), variance / n, 0.0)
    if variance <= 0:
        return none

    def multiply(q: np.ndarray) -> tuple[np.ndarray, float]:
        def both(c: np.ndarray) -> np.ndarray:
            y = c @ q
            return np.append(y @ c, y @ y)

        made = summed(blocks, width, mean, both)
        return made[:-1], float(made[-1])

    values, vectors = bidiagonal(multiply, width, variance, components)
    real = values > 1e-12 * math.sqrt(variance)
    vectors, spread = vectors[real], values[real] ** 2 / n
    if not len(spread):
        return none

    def moments(c: np.ndarray) -> np.ndarray:
        w = c @ vectors.T / np.sqrt(spread)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    made, k = summed(blocks, width, mean, moments), len(spread)
    centre = made[:k] / n
    covariance = made[k:].reshape(k, k) / n - np.outer(centre, centre)
    return Whitening(n, sums, vectors, spread, variance / n, float(np.abs(covariance - np.eye(k)).max()))


def deviations(rows: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2 by row; None beyond a long."""
    reach = max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0)))) * n + max(map(abs, sums), default=0)
    if reach * reach * max(1, len(sums)) < LONG:
        off = n * rows - np.array(sums)
        return np.einsum("ij,ij->i", off, off).tolist()
    exact = ((n * rows.astype(object) - np.array(sums, dtype=object)) ** 2).sum(axis=1)
    return [int(d) if d < LONG else None for d in exact]


def whiten(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Vectors that are null, or hold null or non-finite entries, go, as do those that are not of the commonest
    length. Repeated rows are fitted once and all returned; null ids stay null. Components of no variance are
    left out, so equal vectors only, or one, give no rows; an empty table gives none. A deviation beyond a
    long is null. Other columns are not read.
    """
    rows = stored(scaled(vectors, column), "scaled")
    fitted = fit_whitening(rows, components)
    if fitted is None or not len(fitted.values):
        return vectors.sparkSession.createDataFrame([], OUT)
    width = len(fitted.sums)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fitted.values)
        for batch in batches:
            x = _matrix(batch.column(1), width)
            white = (x - fitted.mean) @ fitted.components.T / np.sqrt(fitted.values)
            rows = len(x)
            places = np.repeat(np.arange(rows), k)
            every = np.ones(rows * k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * k, fitted.n, dtype=np.int64)),
                 pa.array(deviations(x, fitted.n, fitted.sums), pa.int64()).take(pa.array(places)),
                 pa.array(white.ravel()), pa.array(np.tile(fitted.values / fitted.trace, rows)),
                 pa.array(every * fitted.identity_error)],
                [name.split()[0] for name in OUT.split(", ")],
            )

    return rows.select("vec_id", "x").mapInArrow(project, OUT)


def op13_whitening(vectors: DataFrame) -> DataFrame:
    return whiten(vectors)
