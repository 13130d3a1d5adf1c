"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Tasks sum the centred products of their rows; only the sums, one number per pair of
dimensions, are shuffled and come to the driver. There the scatter is factored as L times
its transpose with pivots on the diagonal, and plane rotations make the columns of L
orthogonal. The squared norms of the rotated columns are the eigenvalues of the scatter,
the columns divided by their norms its eigenvectors: the product L Lᵀ is never formed again,
so small eigenvalues keep their precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedstat.llm.vectors import dense, finite_vectors
from feedstat.session import materialize

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
SWEEPS = 60


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """L with as many columns as the matrix has rank, and L Lᵀ equal to it.

    Each step takes the largest diagonal entry that is left; it ends where that is no more
    than rounding of the first.
    """
    rest = scatter.copy()
    size = len(rest)
    factor = np.zeros((size, size))
    first = rest.diagonal().max(initial=0.0)
    for k in range(size):
        pivot = int(np.argmax(rest.diagonal()))
        value = rest[pivot, pivot]
        if value <= size * np.finfo(float).eps * first:
            return factor[:, :k]
        column = rest[:, pivot] / np.sqrt(value)
        factor[:, k] = column
        rest -= np.outer(column, column)
        rest[pivot, :] = rest[:, pivot] = 0.0
    return factor


def rounds(columns: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``columns`` in rounds in which no column comes twice."""
    players = list(range(columns + columns % 2))
    half, out = len(players) // 2, []
    for _ in range(len(players) - 1):
        pairs = [(a, b) for a, b in zip(players[:half], reversed(players[half:])) if max(a, b) < columns]
        out.append((np.array([min(p) for p in pairs], int), np.array([max(p) for p in pairs], int)))
        players = [players[0], players[-1], *players[1:-1]]
    return out


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """One-sided Jacobi: ``factor`` times a rotation, with columns orthogonal to double precision."""
    turned = factor.copy()
    order = rounds(turned.shape[1])
    limit = np.finfo(float).eps * np.sqrt(max(len(turned), 1))
    for _ in range(SWEEPS):
        worst = 0.0
        for left, right in order:
            a, b = turned[:, left], turned[:, right]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            cosine = np.abs(ab) / np.sqrt(aa * bb)
            turn = cosine > limit
            worst = max(worst, cosine.max(initial=0.0))
            if not turn.any():
                continue
            left, right, a, b, aa, bb, ab = left[turn], right[turn], a[:, turn], b[:, turn], aa[turn], bb[turn], ab[turn]
            zeta = (bb - aa) / (2 * ab)
            tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, tangent)
            sin = cos * tangent
            turned[:, left], turned[:, right] = cos * a - sin * b, sin * a + cos * b
        if worst <= limit:
            return turned
    raise ArithmeticError(f"columns are not orthogonal after {SWEEPS} sweeps")


@dataclass
class Whitening:
    """What a fit leaves: row count, sums per dimension, eigenvalues and unit components by falling eigenvalue."""

    n: int
    sums: np.ndarray
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray


def summed(rows: DataFrame, width: int, of_batch) -> np.ndarray:
    """Sum over all rows of the square matrices ``of_batch(batch)``; tasks send a number per entry of a triangle."""
    at, to = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            total += of_batch(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(at), dtype=np.int32)), pa.array(total[at, to])], ["entry", "value"]
        )

    got = rows.mapInArrow(run, "entry int, value double").groupBy("entry").agg(F.sum("value")).collect()
    out = np.zeros((width, width))
    for entry, value in got:
        out[at[entry], to[entry]] = out[to[entry], at[entry]] = value
    return out


def centred(column: pa.Array, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums`` of each row, exact integers."""
    return n * dense(column, len(sums)) - sums


def fit(vectors: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """Eigenvalues and components of ``x`` (arrays of longs) over all rows; None without rows.

    The driver holds a matrix of dimension by dimension numbers. Components whose eigenvalue
    is zero but for rounding are left out: nothing can be divided by it.
    """
    n, width = vectors.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n:
        return None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += dense(batch["x"], width).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], ["entry", "value"])

    sums = np.zeros(width, np.int64)
    for entry, value in vectors.mapInArrow(add, "entry int, value long").groupBy("entry").agg(F.sum("value")).collect():
        sums[entry] = value

    def products(batch: pa.RecordBatch) -> np.ndarray:
        z = centred(batch["x"], n, sums) / n
        return z.T @ z

    scatter = summed(vectors, width, products) / n
    turned = orthogonal_columns(pivoted_cholesky(scatter))
    norms = np.sqrt((turned * turned).sum(0))
    order = np.argsort(-norms, kind="stable")[:most]
    return Whitening(n, sums, float(np.trace(scatter)), norms[order] ** 2, (turned[:, order] / norms[order]).T)


def project(vectors: DataFrame, found: Whitening) -> DataFrame:
    """``id``, ``deviation`` and ``whitened`` (array) of each row of ``vectors``.

    ``deviation`` is the exact sum of (n x - S)² over dimensions; it is null where a long can't hold it.
    """
    n, sums = found.n, found.sums
    scaled = found.components.T / np.sqrt(found.eigenvalues) if len(found.eigenvalues) else np.zeros((len(sums), 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = centred(batch["x"], n, sums)
            if len(sums) * float(np.abs(y).max(initial=0)) ** 2 < 2.0**62:
                deviation = pa.array((y * y).sum(1))
            else:
                exact = [sum(v * v for v in row) for row in y.tolist()]
                deviation = pa.array([v if v < 2**63 else None for v in exact], pa.int64())
            white = (y / n) @ scaled
            offsets = np.arange(len(white) + 1, dtype=np.int32) * white.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch["id"], deviation, lists], ["id", "deviation", "whitened"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {kind}, deviation long, whitened array<double>")


def identity_error(projected: DataFrame, n: int, width: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity."""
    if not width:
        return 0.0

    def products(batch: pa.RecordBatch) -> np.ndarray:
        # a column of ones beside the values: its products are their sums
        w = np.hstack([dense(batch["whitened"], width), np.ones((batch.num_rows, 1))])
        return w.T @ w

    total = summed(projected, width + 1, products) / n
    means = total[:width, width]
    return float(np.abs(total[:width, :width] - np.outer(means, means) - np.eye(width)).max())


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = COMPONENTS,
    scale: int = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """A row per vector and component: ``id_col``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Components c of a vector become the long ``floor(scale * c) + shift``. Rows whose vector
    is null or holds null or non-finite entries are dropped. Entries that a shorter vector
    lacks count as c = 0. Repeated rows, equal vectors and null ids stay rows of their own.
    Fewer components come where the covariance has a smaller rank: equal vectors, or a single
    one, have none and give no rows; neither does an empty table. Other columns are not read.
    """
    cells = F.transform("vector", lambda c: F.floor(c * scale).cast("long") + F.lit(shift).cast("long"))
    vectors = materialize(finite_vectors(rows, id_col, vec_col).select("id", cells.alias("x")), "whiten-vectors")
    width = vectors.agg(F.max(F.size("x"))).first()[0] or 0
    lacking = F.array_repeat(F.lit(shift).cast("long"), F.lit(width) - F.size("x"))
    vectors = vectors.withColumn("x", F.concat("x", lacking))
    found = fit(vectors, most)
    if found is None:
        found = Whitening(0, np.zeros(0, np.int64), 0.0, np.zeros(0), np.zeros((0, 0)))
    projected = materialize(project(vectors, found), "whiten-rows")
    error = identity_error(projected, found.n, len(found.eigenvalues))
    explained = F.array(*[F.lit(float(e / found.trace)) for e in found.eigenvalues]).cast("array<double>")
    return projected.select(
        F.col("id").alias(id_col), "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        id_col, (F.col("place") + 1).cast("int").alias("component"), F.lit(found.n).cast("long").alias("n"),
        "deviation", "whitened", F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """All vectors of ``embeddings``, whitened to at most 8 components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op13_whitening": op13_whitening}
