"""Models that leave a group out: no row is copied for a group, and there may be any number of groups."""

import numpy as np
import pytest

from spanloom.operators import learn


def fitted(x, y, l2=1.0):
    mean = np.nanmean(x, axis=0)
    sd = np.nanstd(x, axis=0)
    sd[sd < 1e-9] = 1
    z = np.c_[np.ones(len(x)), np.where(np.isnan(x), 0, (x - mean) / sd)]
    beta, ridge = np.zeros(z.shape[1]), np.diag([0.0] + [l2] * x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ beta))
        move = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(beta)), z.T @ (y - p) - ridge @ beta)
        beta += move
        if np.abs(move).max() < 1e-9:
            break
    return lambda x: 1 / (1 + np.exp(-(beta[0] + np.where(np.isnan(x), 0, (x - mean) / sd) @ beta[1:])))


@pytest.mark.parametrize("pack", [2000, 4])
def test_more_groups_than_a_thousand(spark, monkeypatch, pack):
    monkeypatch.setattr(learn, "PACK_MODELS", pack if pack > 100 else 500)
    rng = np.random.default_rng(pack)
    groups = 1300 if pack > 100 else 700
    n = groups * 3
    x = rng.normal(size=(n, 2))
    x[rng.random((n, 2)) < 0.05] = np.nan
    y = (rng.random(n) < 1 / (1 + np.exp(-np.nan_to_num(x[:, 0]) - 0.5))).astype(float)
    g = rng.integers(0, groups, n)
    rows = [(k, int(g[k]), *(None if np.isnan(v) else float(v) for v in x[k]), float(y[k])) for k in range(n)] + [(n, None, 0.1, 0.2, 1.0), (n + 1, 5, 0.1, 0.2, None)]
    df = spark.createDataFrame(rows, "k long, g long, a double, b double, y double")
    scored = learn.left_out_scores(df, "g", ["a", "b"], "y")
    got = {r["k"]: r["p"] for r in scored.collect()}
    for one in rng.choice(np.unique(g), 12, replace=False):
        model = fitted(x[g != one], y[g != one])
        at = np.flatnonzero(g == one)
        assert np.allclose([got[k] for k in at], model(x[at]), atol=1e-6)
    assert got[n] is None and got[n + 1] is not None


def test_no_nested_loop(spark):
    df = spark.createDataFrame([(k, k % 3, float(k % 7), float(k % 2)) for k in range(60)], "k long, g long, a double, y double")
    plan = learn.left_out_scores(df, "g", ["a"], "y")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
