"""Whitening against a plain covariance of whole numbers, on tables that are hard."""

from decimal import Decimal

import numpy as np
import pytest

from barpath.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, component string, n string, key string"


def table(spark, vectors, keys=None):
    return spark.createDataFrame([(i if keys is None else keys[i], v, "clash", "x", "y") for i, v in enumerate(vectors)], SCHEMA)


def plain(vectors):
    """For vectors of one length: n, deviations, eigenvalues falling, covariance."""
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(d)]
    deviation = [sum((n * r[k] - s[k]) ** 2 for k in range(d)) for r in x]
    v = [[float(Decimal(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x)) / n**3) for j in range(d)] for i in range(d)]
    return n, deviation, np.linalg.eigvalsh(np.array(v))[::-1], np.array(v), np.array(x), np.array(s)


def against(rows, vectors, keys):
    n, deviation, values, v, x, s = plain(vectors)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    for i, k in enumerate(keys):
        assert sorted(got[k]) == list(range(1, min(8, x.shape[1]) + 1))
        for c, r in got[k].items():
            assert r.n == n and r.deviation == deviation[i]
            assert r.explained == pytest.approx(values[c - 1] / np.trace(v), rel=1e-9)
    w = np.array([[got[k][c].whitened for c in sorted(got[k])] for k in keys])
    error = np.abs(np.cov(w.T, bias=True) - np.eye(w.shape[1])).max()
    assert error < 1e-9 and next(iter(rows)).identity_error == pytest.approx(error, abs=1e-9)
    # each component is the projection on a unit eigenvector: of variance e, and all rows see the same one
    centred = x - s / n
    axes = np.linalg.lstsq(centred, w * np.sqrt(values[: w.shape[1]]), rcond=None)[0]
    assert np.allclose(np.linalg.norm(axes, axis=0), 1, atol=1e-8) and np.allclose(v @ axes, axes * values[: w.shape[1]], rtol=1e-6, atol=1e-6 * values[0])


@pytest.mark.parametrize("dims, tile, block_rows", [(10, 4, 7), (3, 2, 1000), (64, 32, 16)])
def test_whitening(spark, dims, tile, block_rows):
    rng = np.random.default_rng(dims)
    vectors = (rng.standard_normal((150, dims)) * np.linspace(0.1, 3, dims) @ rng.standard_normal((dims, dims)) * 0.1).tolist()
    vectors[7] = vectors[8]
    keys = [3 * i - 40 for i in range(150)]
    odd = [None, [], [None] * dims, [float("nan")] * dims, [float("inf")] + [0.0] * (dims - 1), [1e300] * dims]
    df = table(spark, vectors + odd, keys + [900 + i for i in range(len(odd))])
    against(whitening.whiten(df, tile=tile, block_rows=block_rows).collect(), vectors, keys)


def test_lengths_are_spaces_of_their_own(spark):
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal((40, 5)).tolist(), rng.standard_normal((30, 2)).tolist()
    rows = whitening.whiten(table(spark, a + b)).collect()
    against([r for r in rows if r.vec_id < 40], a, range(40))
    against([r for r in rows if r.vec_id >= 40], b, range(40, 70))


def test_no_variance(spark):
    one = whitening.whiten(table(spark, [[1.0, 2.0, 3.0]])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(c, 1, 0, None, None, None) for c in (1, 2, 3)]
    line = whitening.whiten(table(spark, [[float(i), 1.0, 2.0 * i] for i in range(9)], [None, None, *range(7)])).collect()
    assert len(line) == 27 and sum(r.vec_id is None for r in line) == 6
    first = [r for r in line if r.component == 1]
    assert all(r.whitened is not None and r.explained == pytest.approx(1) and r.identity_error < 1e-9 for r in first)
    assert all(r.whitened is None for r in line if r.component > 1)
    assert whitening.whiten(table(spark, [None, []])).count() == 0 and whitening.whiten(table(spark, [[1.0]]).limit(0)).count() == 0


def test_deviation_beyond_a_long(spark):
    got = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, [[0.0], [4e6], [1.0]])).collect()}
    x = [100_000, 4_096_000_000 + 100_000, 101_024]
    exact = [(3 * v - sum(x)) ** 2 for v in x]
    assert got == {i: e if e < 1 << 63 else None for i, e in enumerate(exact)} and None in got.values()


def test_query(spark, sf):
    rows = whitening.op12_whitening(spark, sf).collect()
    source = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    good = [r for r in source if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    against(rows, [[float(c) for c in r.embedding] for r in good], [r.vec_id for r in good])
