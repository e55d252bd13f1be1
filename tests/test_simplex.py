"""Weights by quadratic programme against a fine grid and against the fixed grid."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockpulse.operators import forecasting, simplex


def by_grid(gram, target, step=0.001):
    n = round(1 / step)
    i, j = np.meshgrid(np.arange(n + 1), np.arange(n + 1), indexing="ij")
    w = np.stack([i, j, n - i - j], axis=-1).reshape(-1, 3)
    w = w[w[:, 2] >= 0] * step
    values = np.einsum("ni,ij,nj->n", w, gram, w) - 2 * w @ target
    return w[values.argmin()], values.min()


@pytest.mark.parametrize("seed", range(12))
def test_equal_to_a_fine_grid(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(50, 3)) + rng.normal(size=(50, 1)) * 3
    if seed % 4 == 0:
        x[:, 1] = x[:, 0]  # members that coincide
    y = x @ rng.normal(size=3) + rng.normal(size=50)
    gram, target = x.T @ x / 50, x.T @ y / 50
    w = simplex.best_weights(gram, target)
    near, least = by_grid(gram, target)
    value = w @ gram @ w - 2 * target @ w
    assert w.min() >= 0 and w.sum() == pytest.approx(1) and value <= least + 1e-9
    if seed % 4:
        assert np.abs(w - near).max() < 0.02


def test_never_worse_than_the_fixed_grid(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in ("x", "y", "z"):
        for _ in range(200):
            a = rng.uniform(5, 50)
            rows.append((c, float(a), *(float(a * f + rng.normal(0, s)) for f, s in ((1.1, 3), (0.9, 6), (1.0, {"x": 1, "y": 9, "z": 4}[c])))))
    rows.append(("x", 1.0, 2.0, None, 1.0))
    scored = spark.createDataFrame(rows, "category string, actual double, seasonal double, naive double, lookback double")
    fixed = {r.category: r for r in forecasting.tune_weights(scored).collect()}
    for r in simplex.fit_weights(scored).collect():
        grid = fixed[r.category]
        mix = sum(F.col(m) * grid[f"w_{m}"] for m in ("seasonal", "naive", "lookback"))
        rmse = scored.filter((F.col("category") == r.category) & F.col("naive").isNotNull()).agg(F.sqrt(F.avg((mix - F.col("actual")) ** 2))).first()[0]
        assert r.rows == 200 and r.rmse <= rmse + 1e-9
        mine = sum(F.col(m) * r[f"w_{m}"] for m in ("seasonal", "naive", "lookback"))
        assert r.rmse == pytest.approx(scored.filter((F.col("category") == r.category) & F.col("naive").isNotNull()).agg(F.sqrt(F.avg((mine - F.col("actual")) ** 2))).first()[0])


def test_no_rows(spark):
    empty = spark.createDataFrame([], "category string, actual double, seasonal double, naive double, lookback double")
    assert simplex.fit_weights(empty).count() == 0
