"""Shapley values of boosted trees against all subsets, and their sum against the model's prediction."""

import itertools
import math
import random

import numpy as np
import pytest
from conftest import sales_rows
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from stockpulse.operators import causal, tree_shap

INPUTS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(8)
    rows = [tuple(float(rng.randint(0, 9)) for _ in INPUTS) for _ in range(500)]
    rows = [(*r, r[0] * 2 + (5 if r[1] > 4 else 0) * r[2]) for r in rows]
    df = spark.createDataFrame(rows, "a double, b double, c double, label double").coalesce(1)
    x = VectorAssembler(inputCols=INPUTS, outputCol="features").transform(df)
    return df, x, GBTRegressor(maxIter=4, maxDepth=4, stepSize=0.3, seed=1).fit(x)


def known_expectation(nodes, x, known, at=0):
    prediction, left, right, feature, threshold, rows = nodes[at]
    if left < 0:
        return prediction
    if feature in known:
        return known_expectation(nodes, x, known, left if x[feature] <= threshold else right)
    return sum(nodes[c][5] / rows * known_expectation(nodes, x, known, c) for c in (left, right))


def by_subsets(nodes, x, n):
    out = [0.0] * n
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for k in range(n):
            for s in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n)
                out[i] += w * (known_expectation(nodes, x, {*s, i}) - known_expectation(nodes, x, set(s)))
    return out


def test_equal_to_all_subsets():
    #            prediction, left, right, feature, threshold, rows; a feature twice on one way
    nodes = {0: (0, 1, 2, 0, 5.0, 100), 1: (0, 3, 4, 1, 2.0, 60), 2: (0, 5, 6, 0, 8.0, 40), 3: (1.0, -1, -1, -1, 0, 20), 4: (4.0, -1, -1, -1, 0, 40),
             5: (0, 7, 8, 2, 1.0, 30), 6: (9.0, -1, -1, -1, 0, 10), 7: (-2.0, -1, -1, -1, 0, 12), 8: (3.0, -1, -1, -1, 0, 18)}
    leaves, base = tree_shap.leaves_of(nodes, 1.0)
    assert base == pytest.approx(known_expectation(nodes, [0, 0, 0], set()))
    x = np.array([[a, b, c] for a in (1.0, 5.0, 6.0, 8.0, 9.0) for b in (2.0, 3.0) for c in (0.0, 1.0, 2.0)])
    got = tree_shap.shap_values(leaves, x)
    for row, phi in zip(x, got):
        assert phi == pytest.approx(by_subsets(nodes, row, 3))


def test_effects_sum_to_the_prediction(spark, fitted):
    df, x, model = fitted
    out = tree_shap.attribute(df.repartition(3), model, INPUTS)
    total = F.col("base") + sum((F.col(f"{c}_effect") for c in INPUTS), F.lit(0.0))
    want = {tuple(r[c] for c in INPUTS): r.prediction for r in model.transform(x).collect()}
    got = {tuple(r[c] for c in INPUTS): r.total for r in out.withColumn("total", total).collect()}
    assert len(got) > 300 and all(got[k] == pytest.approx(want[k]) for k in want)


def test_spikes_without_features_stay(spark):
    sales = sales_rows(spark, [20 + i % 5 + (60 if i % 17 == 0 else 0) for i in range(120)])
    keys = ["sku_id", "region", "date"]
    full = sales.select(*keys, "sales_qty", "is_promotion", "is_holiday", *[F.lit(20.0 + i).alias(c) for i, c in enumerate(("rolling_mean_7", "rolling_mean_28", "lag_7"))],
                        F.lit(0.0).alias("competitor_price_delta"), F.lit(1.0).alias("weather_score"), F.dayofweek("date").alias("day_of_week"), F.month("date").alias("month"))
    full = full.withColumn("lag_7", F.when(F.dayofmonth("date") > 3, F.col("lag_7")))
    spikes = sales.filter("sales_qty > 70")
    rows = causal.attribute_spikes_boosted(full, spikes, keys, maxIter=3, maxDepth=3).collect()
    assert len(rows) == spikes.count() and any(r.predicted is None for r in rows)
    for r in rows:
        if r.predicted is not None:
            assert r.predicted == pytest.approx(r.base + r.promotion_effect + r.level_effect + r.competitor_effect + r.weather_effect + r.season_effect)
