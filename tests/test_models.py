"""Forest, clusters and matching by their properties."""

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stockpulse.operators import anomaly, causal, clustering, isolation_forest


def test_planted_outliers_rank_first(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (500, 2)))]
    rows += [(1000 + i, 9.0 + i, -9.0 - i) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, a double, b double").repartition(5)
    forest = isolation_forest.fit_forest(df, ["id"], ["a", "b"], n_trees=60)
    scored = isolation_forest.score_forest(df, forest)
    worst = {r.id for r in scored.orderBy("raw_score").limit(5).collect()}
    assert worst == {1000 + i for i in range(5)} and len(forest.trees) == 60
    low, high = scored.agg(F.min("raw_score"), F.max("raw_score")).first()
    assert -1.0 <= low < high <= 0.0


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 97).cast("double").alias("x"))
    take = lambda d: sorted(map(tuple, isolation_forest.tree_sample(d, ["id"], ["x"], 7, 64)[0].collect()))
    first = take(df.repartition(3))
    assert first == take(df.repartition(11)) and len(first) == 7 * 64
    per_tree = {}
    for tree, key, _ in first:
        per_tree.setdefault(tree, set()).add(key)
    assert all(len(v) == 64 for v in per_tree.values()) and len(per_tree) == 7


@pytest.mark.parametrize("n", [1, 2, 5])
def test_tiny_and_constant_inputs(spark, n):
    df = spark.range(n).select("id", F.lit(1.0).alias("x"))
    forest = isolation_forest.fit_forest(df, ["id"], ["x"], n_trees=5)
    assert isolation_forest.score_forest(df, forest).count() == n


def test_series_scores(spark, tables):
    rows = spark.createDataFrame([("A", "R", i, -float(i)) for i in range(5)] + [("B", "R", 0, -3.0)], "sku_id string, region string, d int, raw_score double")
    got = {(r.sku_id, r.d): r.anomaly_score for r in anomaly.scale_scores(rows).collect()}
    assert got[("A", 4)] == pytest.approx(1.0, abs=1e-6) and got[("A", 0)] == pytest.approx(0.0, abs=1e-6) and got[("B", 0)] == 1.0
    spread = {(r.sku_id, r.d): r.anomaly_score for r in anomaly.scale_scores(rows, "global").collect()}
    assert spread[("B", 0)] == pytest.approx(0.75, abs=1e-6)
    with pytest.raises(ValueError):
        anomaly.scale_scores(rows, "other")


def blobs(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k, (v, m) in enumerate([(100, 60), (10, 60), (100, 10), (10, 10)]):
        for i in range(30):
            rows.append((f"{k}-{i}", v + rng.normal(0, 1), m + rng.normal(0, 1), 100.0, 1.0, 0.0, 1.0, 50.0))
    return spark.createDataFrame(rows, "sku_id string, " + ", ".join(f"{c} double" for c in clustering.MATRIX_COLUMNS))


def test_blobs_are_recovered_and_labelled(spark):
    out = clustering.sku_clusters(blobs(spark), 4, ["velocity", "margin"]).collect()
    label = {}
    for r in out:
        label.setdefault(r.sku_id[0], set()).add(r.cluster_label)
    assert label == {"0": {"Stars"}, "1": {"Cash Cows"}, "2": {"Volume Movers"}, "3": {"Tail SKUs"}}
    assert [r.cluster_label for r in out] == sorted(r.cluster_label for r in out)


def test_silhouette_picks_four(spark):
    scaled, _ = clustering.standardize(blobs(spark), ["sales_velocity", "gross_margin"])
    reduced = clustering.principal_components(scaled, "scaled", 2)
    assert clustering.find_optimal_k(reduced, (2, 5)) == 4


def test_components_keep_the_share(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2).cast("double").alias("b"), (F.rand(3) * 1e-3).alias("c"))
    scaled, _ = clustering.standardize(df.withColumn("c", F.lit(0.0)), ["a", "b", "c"])
    assert len(clustering.principal_components(scaled, "scaled", 3).first().features) == 1


def test_unknown_features_fall_back_to_all(spark):
    assert clustering.fx.pick_columns(blobs(spark), ["nothing"], clustering.MATRIX_COLUMNS, clustering.ALIASES) == clustering.MATRIX_COLUMNS


def test_empty_matrix(spark):
    assert clustering.sku_clusters(blobs(spark).limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["spread", "narrow", "hot", "few"])
def test_nearest_match_equals_brute_force(spark, kind):
    rng = np.random.default_rng({"spread": 1, "narrow": 2, "hot": 3, "few": 4}[kind])
    n = 6 if kind == "few" else 300
    draw = {"spread": lambda k: rng.random(k), "narrow": lambda k: 0.5 + rng.random(k) * 1e-6,
            "hot": lambda k: np.where(rng.random(k) < 0.4, 0.25, rng.random(k)), "few": lambda k: rng.integers(0, 3, k) / 2}[kind]
    left = [(f"t{i}", int(i % 3), float(s)) for i, s in enumerate(draw(n))]
    right = [(f"c{i:04d}", int(i % 3), float(s)) for i, s in enumerate(draw(2 * n)) if i % 3 != 2 or kind == "spread"]
    got = causal.nearest_match(spark.createDataFrame(left, "sku_id string, cluster int, s double"),
                               spark.createDataFrame(right, "control string, cluster int, s double"), "cluster", "s", "control", buckets=16)
    found = {r.sku_id: (r.matched_control, r.matched_score) for r in got.collect()}
    expected = {}
    for sku, c, s in left:
        pool = [(abs(x - s), x, i) for i, k, x in right if k == c]
        if pool:
            d = min(p[0] for p in pool)
            x = min(p[1] for p in pool if p[0] == d)
            expected[sku] = (min(p[2] for p in pool if p[1] == x), x)
    assert found == expected


def test_attribution_recovers_the_promotion(spark):
    rows = [(i, 100 + 50 * (i % 4 == 0), i % 4 == 0, 100.0 + (i % 3) * 1e-3, float(i % 5), float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, sales_qty long, is_promotion boolean, rolling_mean_28 double, competitor_price_delta double, weather_score double")
    r = causal.attribute_spikes(df, df.filter("id = 4"), ["id"]).first()
    assert r.promotion_effect == pytest.approx(50 * 0.75, rel=0.02) and abs(r.weather_effect) < 1


def test_detection_filters(spark, tables):
    from stockpulse.plans import api

    events = api.detect_anomalies(tables, 180, region="ASIA", min_score=0.0, n_trees=10)
    assert SF and all(r.region == "ASIA" and 0 <= r.anomaly_score <= 1 for r in events.collect())


def test_propensity_after_an_observed_query(spark):
    """A session that has observed a query cannot be sent to tasks; the scoring must not need it."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("rows")).collect()
    assert seen.get["rows"] == 3
    rows = [(f"S{i}", i % 2, *[float((i * (c + 3)) % 17) for c in range(7)]) for i in range(40)]
    matrix = spark.createDataFrame(rows, ["sku_id", "cluster", *clustering.MATRIX_COLUMNS])
    treated = matrix.filter("sales_velocity > 9").select("sku_id")
    scored = causal.propensity(matrix, treated).collect()
    assert len(scored) == 40 and all(0 < r.propensity < 1 for r in scored)
    assert min(r.propensity for r in scored if r.treated) > min(r.propensity for r in scored if not r.treated)
