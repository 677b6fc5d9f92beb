"""Sparse lasso with screening and optimality checks against plain coordinate descent on the dense design."""

import numpy as np
import pytest

from lodestat.operators import sparse_lasso as sl


def brute(X, y, alpha, sweeps=20_000):
    n, p = X.shape
    xc, yc = X - X.mean(0), y - y.mean()
    w, z, r = np.zeros(p), (xc**2).sum(0), yc.copy()
    for _ in range(sweeps):
        big = 0.0
        for j in range(p):
            if z[j] <= 1e-12:
                continue
            old = w[j]
            rho = xc[:, j] @ r + z[j] * old
            new = np.sign(rho) * max(abs(rho) - n * alpha, 0.0) / z[j]
            if new != old:
                r -= xc[:, j] * (new - old)
                w[j], big = new, max(big, abs(new - old))
        if big < 1e-13:
            break
    return w, y.mean() - X.mean(0) @ w


@pytest.fixture(scope="module")
def design(spark):
    rng = np.random.default_rng(3)
    n, p = 240, 50
    X = (rng.random((n, p)) < 0.12) * rng.integers(1, 5, (n, p))
    X[:, 7] = 0
    X[:, 8] = 2  # no variance
    true = np.zeros(p)
    true[[1, 4, 9, 20]] = [2, -1.5, 1, 0.5]
    y = X @ true + rng.normal(0, 0.5, n)
    cells = [(i, j, float(X[i, j]) / 2) for i in range(n) for j in range(p) if X[i, j]] * 2  # repeated cells add up
    cdf = spark.createDataFrame(cells, "doc_id long, pos long, cnt double")
    ydf = spark.createDataFrame([(i, float(y[i])) for i in range(n)] + [(n + 5, 1.0), (n + 6, None)], "doc_id long, y double")
    return np.vstack([X, np.zeros(p)]), np.append(y, 1.0), cdf, ydf


@pytest.mark.parametrize("alpha", [5.0, 0.5, 0.05, 0.005])
def test_matches_coordinate_descent(design, alpha):
    X, y, cdf, ydf = design
    fit = sl.fit(cdf, ydf, alpha)
    w, b = brute(X, y, alpha)
    got = np.zeros(X.shape[1])
    for c, v in fit.weights.items():
        got[c] = v
    assert np.abs(got - w).max() < 1e-8 and abs(fit.intercept - b) < 1e-8
    assert set(fit.weights) == set(np.flatnonzero(w).tolist())


def test_violations_enter_the_working_set(design, monkeypatch):
    X, y, cdf, ydf = design
    monkeypatch.setattr(sl, "_first_working", lambda corr, var, n, alpha, lam_max: set())
    fit = sl.fit(cdf, ydf, 0.05)
    w, _ = brute(X, y, 0.05)
    assert fit.rounds > 1 and set(fit.weights) == set(np.flatnonzero(w).tolist())


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, pos long, cnt double")
    assert sl.fit(none, spark.createDataFrame([], "doc_id long, y double"), 0.1).weights == {}
