"""Whitening against a library's eigenvectors and exact integers."""

import random

import numpy as np
import pytest

from modelwatch.llm import whitening

FIELDS = "vec_id bigint, vector array<bigint>, n int, component string, i int, part int, whitened string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3, "y") for i, v in vectors], FIELDS).repartition(4)


@pytest.mark.parametrize("m", [1, 2, 7, 40])
def test_spectrum(m):
    rng = np.random.default_rng(m)
    x = rng.standard_normal((4 * m, m))
    a = x.T @ x
    values, vectors = whitening.spectrum(a, max(1, m // 2))
    true, base = np.linalg.eigh(a)
    assert np.allclose(values, true[::-1][: len(values)], rtol=1e-12)
    assert np.allclose(np.abs((vectors * base[:, ::-1][:, : len(values)]).sum(axis=0)), 1, atol=1e-11)


@pytest.mark.parametrize("diagonal", [[0, 0, 0], [3, 3, 3], [1, 0, 0, 0], [2, 2, 1, 1, 0], [1, 2, 3, 2, 1, 2, 2], [1e9, 1, 1e-9], [-1, 1, 0]])
def test_spectrum_with_ties(diagonal):
    turn = np.linalg.qr(np.random.default_rng(5).standard_normal((len(diagonal),) * 2))[0]
    a = turn @ np.diag(np.array(diagonal, float)) @ turn.T
    values, vectors = whitening.spectrum(a)
    assert np.allclose(values, sorted(diagonal, reverse=True), atol=1e-12 * max(1, *map(abs, diagonal)))
    assert np.allclose(vectors.T @ vectors, np.eye(len(diagonal)), atol=1e-12)
    assert np.allclose(a @ vectors, vectors * values, atol=1e-12 * max(1, *map(abs, diagonal)))


def check(got, vectors, d, components):
    """Rows against the definition in plain numpy."""
    live = [(i, v) for i, v in vectors if v is not None and None not in v and len(v) == d]
    fit = np.array(sorted({tuple(v) for _, v in live}), dtype=np.int64)
    n, sums = len(fit), [sum(map(int, c)) for c in fit.T]
    covariance = np.cov(fit.T - fit.mean(axis=1 - 1)[:, None], bias=True).reshape(d, d)
    values, base = np.linalg.eigh(covariance)
    values, base = values[::-1], base[:, ::-1]
    k = min(components, d, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == len(live) * k
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert abs(r["explained"] / (values[r["component"] - 1] / values.sum()) - 1) < 1e-9
    for c in range(1, k + 1):
        true = sorted((str(i), sum((n * int(x) - s) ** 2 for x, s in zip(v, sums, strict=True)), (np.array(v) - fit.mean(axis=0)) @ base[:, c - 1] / np.sqrt(values[c - 1])) for i, v in live)
        mine = sorted((str(r["vec_id"]), r["deviation"], r["whitened"]) for r in by[c])
        sign = np.sign(sum(a[2] * b[2] for a, b in zip(true, mine, strict=True)))
        true = sorted((i, dev, sign * w) for i, dev, w in true)
        for (i, dev, w), (j, e, v) in zip(true, mine, strict=True):
            assert (i, dev) == (j, e) and abs(w - v) < 1e-8


def test_plain(spark):
    rng = random.Random(3)
    vectors = [(i, [1_000_000 + round(rng.gauss(0, 6 + 2 * j)) for j in range(5)]) for i in range(300)]
    vectors += vectors[:40] + [(1000 + i, vectors[7][1]) for i in range(90)]  # repeated rows and repeated vectors
    vectors += [(None, vectors[3][1]), (2000, None), (2001, [1, None, 2, 3, 4]), (2002, []), (2003, [5] * 4)]
    for components in (16, 3):
        check(whitening.whiten(table(spark, vectors), components=components).collect(), vectors, 5, components)


def test_without_variance(spark):
    """One dimension is constant, another the sum of two."""
    rng = random.Random(4)
    vectors = []
    for i in range(80):
        a, b = rng.randrange(50), rng.randrange(9)
        vectors.append((i, [a, 7, b, a + b]))
    check(whitening.whiten(table(spark, vectors)).collect(), vectors, 4, 16)


def test_small(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for vectors in ([], [(1, [5, 6])], [(1, [5, 6])] * 9, [(1, None), (2, [])]):
        got = whitening.whiten(table(spark, vectors))
        assert got.columns == names and got.collect() == []
    check(whitening.whiten(table(spark, [(1, [5, 6]), (2, [8, 8])])).collect(), [(1, [5, 6]), (2, [8, 8])], 2, 16)


def test_large_entries(spark):
    """Deviations beyond 64 bits are null, entries beyond 2^40 bounded."""
    got = whitening.whiten(table(spark, [(1, [1 << 62, 0]), (2, [0, 1 << 39]), (3, [-(1 << 62), 5])])).collect()
    assert len(got) == 6 and all(r["deviation"] is None and np.isfinite(r["whitened"]) for r in got)
