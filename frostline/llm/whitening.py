"""Whitening of embeddings by shifted CholeskyQR.

Every pass sums the Gram matrix of the rows orthogonalised so far over all tasks, and the triangular factor of that
small matrix takes the rows one step nearer to orthonormal ones. The rows themselves are never kept: a task centres its
rows and solves with the factors found so far. The product R of the factors has the singular values and right singular
vectors of the centred rows, so one SVD of it gives the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 2.0**31  # of an entry times 64
UNIT = np.finfo(np.float64).eps / 2
LONG = (1 << 63) - 1


def usable(vectors: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Rows with a vector of finite entries of the most common length, and that length (0: there are none)."""
    good = vectors.where(F.col(column).isNotNull() & (F.size(column) > 0)).where(
        F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * 64) < MOST))
    )
    found = good.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = found["d"] if found else 0
    return good.where(F.size(column) == d), d


def _whole(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The integers floor(64 c) + 1000000 of a batch of vectors."""
    flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(64.0 * flat).astype(np.int64).reshape(-1, d) + 1_000_000


def _solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows R^-1 for an upper triangular R."""
    out = np.empty_like(rows)
    for j in range(len(r)):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _summed(rows: DataFrame, column: str, d: int, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray], exact: bool = False) -> np.ndarray:
    """Sum over all tasks of ``part``, a matrix of the given shape for the integers of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                one = part(_whole(b, d))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total))], ["i", "v"])

    parts = rows.select(column).mapInArrow(run, f"i int, v array<{'bigint' if exact else 'double'}>").select("i", F.posexplode("v").alias("j", "v"))
    total = np.zeros(shape, dtype=np.int64 if exact else np.float64)
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # as wide as a vector, whatever the rows
        total[r.i, r.j] = r.v
    return total


def factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper triangular factor of a Gram matrix, shifted by what rounding may have taken if it has to be."""
    d = len(gram)
    shift = 11.0 * (n * d + d * (d + 1)) * UNIT * np.linalg.norm(gram, 2)
    while True:
        try:
            return np.linalg.cholesky(gram + np.eye(d) * shift if shifted else gram).T
        except np.linalg.LinAlgError:
            shift, shifted = shift * (10 if shifted else 1), True


def decompose(gram_of: Callable[[list[np.ndarray]], np.ndarray], n: int, passes: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right singular vectors (rows) of the matrix whose Gram matrix ``gram_of`` gives after each
    solve with the factors so far; passes end when the rows are orthonormal to rounding."""
    factors: list[np.ndarray] = []
    for k in range(passes):
        gram = gram_of(factors)
        if not gram.any():
            return np.zeros(0), np.zeros((0, len(gram)))
        if k and np.abs(gram - np.eye(len(gram))).max() <= 4 * len(gram) * UNIT:
            break
        factors.append(factor(gram, n, shifted=not k))
    r = np.eye(len(factors[0]))
    for f in factors:
        r = f @ r
    _, sigma, right = np.linalg.svd(r)
    return sigma, right


def whiten(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = 32) -> DataFrame:
    """A row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Vectors that are null, empty or hold null or non-finite entries are left out, as are those of another length than most
    (shorter among ties) and those with an entry of 2^25 or more. Repeated rows and null keys count like others. A direction
    in which the rows don't differ has no whitened values: a table has no more components than its rank, and one with a
    single distinct vector or none gives an empty result. ``deviation`` is null where it is larger than a long. What the driver
    holds is a few matrices as wide as a vector. Components of equal eigenvalues may come in any order.
    """
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, d = usable(vectors, column)
    if not d:
        return vectors.sparkSession.createDataFrame([], schema)
    counted = _summed(rows, column, d, (1, d + 1), lambda x: np.append(x.sum(axis=0), len(x))[None, :], exact=True)[0]
    sums, n = counted[:d], int(counted[d])

    def gram_of(factors: list[np.ndarray]) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            y = (n * x - sums) / n
            for r in factors:
                y = _solved(y, r)
            return y.T @ y

        return _summed(rows, column, d, (d, d), part)

    sigma, right = decompose(gram_of, n)
    keep = sigma > 1e-10 * sigma[:1]
    if not keep.any():
        return vectors.sparkSession.createDataFrame([], schema)
    explained = (sigma**2 / (sigma**2).sum())[keep][:components]
    scaled = (right[keep] * (np.sqrt(n) / sigma[keep])[:, None])[:components].T

    def projected(x: np.ndarray) -> np.ndarray:
        return (n * x - sums) / n @ scaled

    width = scaled.shape[1]
    spread = _summed(rows, column, d, (width, width), lambda x: projected(x).T @ projected(x)) / n
    error = float(np.abs(spread - np.eye(width)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _whole(b, d)
            far = n * x - sums
            if float(np.abs(far).max()) ** 2 * d < LONG:
                deviation = pa.array((far * far).sum(axis=1))
            else:
                exact = [sum(v * v for v in row) for row in far.tolist()]
                deviation = pa.array([v if v <= LONG else None for v in exact], pa.int64())
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), width))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(1).take(each),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * width, n)),
                    deviation.take(each),
                    pa.array(projected(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * width, error)),
                ],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select(column, key).mapInArrow(run, schema)
