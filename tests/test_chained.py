"""Chained regressions against a plain row-by-row computation."""

from __future__ import annotations

import numpy as np
import pytest

from cohortline.operators.chained import IterativeImputer, impute_iterative

COLUMNS = list("abcde")


def ridge(x, y):
    """Bayesian ridge by its usual updates on the rows themselves."""
    mean, centre = x.mean(0), y.mean()
    x, y = x - mean, y - centre
    _, s, v = np.linalg.svd(x, full_matrices=False)
    alpha, lam, old = 1 / (y.var() + np.finfo(float).eps), 1.0, None
    weights = lambda: v.T @ np.diag(1 / (s**2 + lam / alpha)) @ v @ x.T @ y
    for _ in range(300):
        w = weights()
        gamma = (alpha * s**2 / (lam + alpha * s**2)).sum()
        lam = (gamma + 2e-6) / ((w**2).sum() + 2e-6)
        alpha = (len(y) - gamma + 2e-6) / (((y - x @ w) ** 2).sum() + 2e-6)
        if old is not None and np.abs(old - w).sum() < 1e-3:
            break
        old = w
    w = weights()
    return w, centre - mean @ w


def plain(train, new, rounds=10, tolerance=1e-3):
    gaps, new_gaps = np.isnan(train), np.isnan(new)
    means = np.nanmean(train, axis=0)
    x, z = np.where(gaps, means, train), np.where(new_gaps, means, new)
    limit = tolerance * np.nanmax(np.abs(train))
    for _ in range(rounds):
        before = x.copy()
        for f in np.argsort(gaps.mean(0), kind="stable"):
            rest = [c for c in range(x.shape[1]) if c != f]
            w, b = ridge(x[~gaps[:, f]][:, rest], train[~gaps[:, f], f])
            x[gaps[:, f], f] = x[gaps[:, f]][:, rest] @ w + b
            z[new_gaps[:, f], f] = z[new_gaps[:, f]][:, rest] @ w + b
        if np.abs(x - before).max() < limit:
            break
    return z


def data(rng, n):
    base = rng.normal(size=(n, 3))
    x = np.column_stack([base, base @ [1.0, -2.0, 0.5] + rng.normal(size=n), 40 + 9 * base[:, 0] + rng.normal(size=n)])
    x[rng.random(x.shape) < [0.3, 0.1, 0.0, 0.2, 0.1]] = np.nan
    return x


def frame(spark, x):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "i long, " + ", ".join(f"{c} double" for c in COLUMNS)).repartition(5)


@pytest.mark.parametrize("options", [{}, {"rounds": 2}, {"rounds": 3, "most_moments": 0}, {"tolerance": 0.3}])
def test_equals_plain_rounds_on_both_tables(spark, options):
    rng = np.random.default_rng(6)
    train, new = data(rng, 500), data(rng, 60)
    new[0] = np.nan  # also a gap in a column that has none in the fitted rows
    fitted = IterativeImputer.fit(frame(spark, train), COLUMNS, **options)
    options.pop("most_moments", None)
    for table in (train, new):
        got = np.array([tuple(r)[1:] for r in fitted.transform(frame(spark, table)).orderBy("i").collect()], float)
        assert got == pytest.approx(plain(train, table, **options), rel=1e-6, abs=1e-8)


def test_recovers_a_linear_relation_and_leaves_empty_columns(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, float(x), None if i % 10 == 0 else float(3 * x + 1), None) for i, x in enumerate(rng.normal(size=400))],
                               "i long, a double, b double, c double")
    for r in impute_iterative(df, ["a", "b", "c"]).filter("i % 10 = 0").collect():
        assert r["b"] == pytest.approx(3 * r["a"] + 1, abs=1e-2) and r["c"] is None
    assert IterativeImputer.fit(df.limit(0), ["a", "b"]).transform(df).count() == 400
    assert IterativeImputer.fit(df, ["a"]).transform(df.select("i", "a")).count() == 400
