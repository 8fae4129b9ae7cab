"""Whitening against an eigendecomposition of the exact covariance."""

import math

import numpy as np
import pytest

from frostline.llm import whitening
from frostline.llm.queries import QUERIES
from tests.compare import ROOT

NAN, INF = float("nan"), float("inf")


def exact(vectors):
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(c) for c in zip(*x, strict=True)]
    far = [[n * c - s for c, s in zip(row, sums, strict=True)] for row in x]
    y = np.array(far, dtype=np.float64) / n
    return n, [sum(c * c for c in row) for row in far], y


def check(rows, keys, vectors, components=32):
    n, deviation, y = exact(vectors)
    values, basis = np.linalg.eigh(y.T @ y / n)
    values, basis = values[::-1], basis[:, ::-1]
    rank = int((values > 1e-12 * values[0]).sum())
    width = min(rank, components)
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == len(vectors) * width and set(got) == {(k, c + 1) for k in keys for c in range(width)}
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1 and rows[0].identity_error <= 1e-9
    for k, d in zip(keys, deviation, strict=True):
        assert got[k, 1].deviation == d
    for c in range(width):
        mine = np.array([got[k, c + 1].whitened for k in keys])
        other = y @ basis[:, c] / np.sqrt(values[c])
        assert np.allclose(mine, other * np.sign(mine @ other), atol=1e-7)
        assert math.isclose(got[keys[0], c + 1].explained, values[c] / values.sum(), rel_tol=1e-9)


def test_the_query(spark):
    folder = f"{ROOT}/sf0.001"
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    table = [(i, v) for i, v in table if v and all(c is not None and math.isfinite(c) for c in v)]
    check(QUERIES["op12_cholesky_whitening"](spark, folder).collect(), [i for i, _ in table], [v for _, v in table])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0, 3) for i, v in rows], "vec_id long, embedding array<float>, n int, whitened double, i int")


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(c) for c in rng.normal(size=5) * [9, 3, 1, 1, 0.5]]) for i in range(60)]
    bad = [(90, None), (91, []), (92, [1.0, None, 1.0, 1.0, 1.0]), (93, [1.0, NAN, 1.0, 1.0, 1.0]), (94, [1.0, 1.0, INF, 1.0, 1.0]), (95, [1.0] * 4), (96, [-INF] * 5), (97, [1e30] * 5)]
    check(whitening.whiten(frame(spark, good + bad)).collect(), [i for i, _ in good], [v for _, v in good])


def test_rank_and_repeated_rows(spark):
    rng = np.random.default_rng(2)
    three = rng.integers(-50, 50, size=(40, 3))
    rows = [(i, [float(a), float(b), float(a), 1.0, float(c), 2.5 + float(b)]) for i, (a, b, c) in enumerate(three)]
    check(whitening.whiten(frame(spark, rows)).collect(), [i for i, _ in rows], [v for _, v in rows])
    twice = whitening.whiten(frame(spark, [*rows, (None, rows[0][1]), *rows[:20]]), components=2).collect()
    assert len(twice) == 61 * 2 and sum(r.vec_id is None for r in twice) == 2


def test_far_centre_and_wide_spectrum(spark):
    """Variances from 1 to 10^10 around a centre far away, where a plain covariance of uncentred rows would fail."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in 30_000 + rng.normal(size=6) * [1600, 100, 16, 1, 0.1, 0.03]]) for i in range(500)]
    check(whitening.whiten(frame(spark, rows)).collect(), [i for i, _ in rows], [v for _, v in rows])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(frame(spark, rows)).collect() == []


def test_passes_end_at_orthonormal_rows():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(300, 8)) @ np.diag(10.0 ** np.arange(0, -8, -1)) @ rng.normal(size=(8, 8))

    def gram(factors):
        q = a
        for r in factors:
            q = whitening._solved(q, r)
        return q.T @ q

    sigma, right = whitening.decompose(gram, len(a))
    assert np.allclose(sigma, np.linalg.svd(a)[1], rtol=1e-6) and np.allclose(right @ right.T, np.eye(8))
