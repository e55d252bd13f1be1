"""SKU feature matrix, standardising, component selection, K-means and cluster labels."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions import labels
from ..functions import scalar as fx
from ..session import attach_row, stage

#: The seven features.
MATRIX_COLUMNS = ["sales_velocity", "gross_margin", "total_volume", "seasonality_idx", "return_rate",
                  "promo_sensitivity", "avg_order_value"]
#: Short names accepted for features.
ALIASES = {"velocity": "sales_velocity", "margin": "gross_margin", "volume": "total_volume",
           "seasonality": "seasonality_idx", "returns": "return_rate", "promo": "promo_sensitivity", "order_value": "avg_order_value"}
#: Replacements for missing features.
DEFAULTS = {"gross_margin": 20.0, "seasonality_idx": 1.0, "return_rate": 0.0, "promo_sensitivity": 1.0}


def peak_month(sales: DataFrame, as_of, days: int = 365) -> DataFrame:
    """Largest monthly volume per SKU."""
    monthly = fx.trailing(sales, as_of, days).groupBy("sku_id", F.trunc("date", "MM").alias("m")).agg(F.sum("sales_qty").alias("qty"))
    return monthly.groupBy("sku_id").agg(F.max("qty").alias("peak"))


def sku_feature_matrix(sales: DataFrame, products: DataFrame, return_rates: DataFrame, promo_lift: DataFrame, as_of,
                       days: int = 90, min_rows: int = 30) -> DataFrame:
    """Seven features per SKU with at least ``min_rows`` sales rows in the window.

    Every side has one row per SKU before the joins (campaign lifts are averaged first).
    """
    qty, rev = F.col("sales_qty"), F.col("revenue_inr").cast("double")
    cost = products.select("sku_id", F.col("unit_cost_inr").cast("double").alias("cost"))
    base = (
        fx.trailing(sales, as_of, days).join(cost, "sku_id").groupBy("sku_id").agg(
            F.avg(qty).alias("sales_velocity"), F.avg(fx.pct(rev - F.col("cost") * qty, rev)).alias("gross_margin"),
            F.sum(qty).alias("total_volume"), F.avg(fx.ratio(rev, qty)).alias("avg_order_value"),
            F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_rows)
    )
    lift = promo_lift.groupBy("sku_id").agg(F.avg(F.col("lift_ratio").cast("double")).alias("promo_sensitivity"))
    rates = return_rates.select("sku_id", F.col("return_rate_pct").cast("double").alias("return_rate"))
    return (
        base.join(peak_month(sales, as_of), "sku_id", "left").join(rates, "sku_id", "left").join(lift, "sku_id", "left")
        .withColumn("seasonality_idx", fx.ratio("peak", F.col("sales_velocity") * 30))
        .na.fill(DEFAULTS).select("sku_id", *MATRIX_COLUMNS)
    )


def standardize(df: DataFrame, columns, output: str = "scaled"):
    """Zero mean, unit variance vector column, and the fitted scaler."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="raw_features").transform(df.na.fill(0, list(columns)))
    scaler = StandardScaler(inputCol="raw_features", outputCol=output, withMean=True, withStd=True).fit(vectors)
    return scaler.transform(vectors), scaler


def principal_components(df: DataFrame, input_col: str, n: int, share: float = 0.95, output: str = "features") -> DataFrame:
    """Leading components that explain at least ``share`` of the variance."""
    model = PCA(k=n, inputCol=input_col, outputCol="components").fit(df)
    total, kept = 0.0, 0
    for part in model.explainedVariance:
        total, kept = total + float(part), kept + 1
        if total >= share:
            break
    return VectorSlicer(inputCol="components", outputCol=output, indices=list(range(kept))).transform(model.transform(df))


def kmeans(df: DataFrame, k: int, seed: int = 42, features: str = "features") -> DataFrame:
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df).transform(df)


def best_silhouette(df: DataFrame, k_range=(2, 10), seed: int = 42, features: str = "features") -> tuple[int, float]:
    """k with the best silhouette, and that silhouette; only the vector column is held while fitting."""
    vectors = df.select(features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        top = min(k_range[1], vectors.count() - 1)
        best_k, best = 4, -1.0
        score = ClusteringEvaluator(featuresCol=features, predictionCol="cluster")
        for k in range(k_range[0], top + 1):
            labelled = kmeans(vectors, k, seed, features)
            if labelled.select("cluster").distinct().count() < 2:
                continue
            value = score.evaluate(labelled)
            if value > best:
                best_k, best = k, value
        return best_k, best
    finally:
        vectors.unpersist()


def find_optimal_k(df: DataFrame, k_range=(2, 10), seed: int = 42, features: str = "features") -> int:
    return best_silhouette(df, k_range, seed, features)[0]


def label_clusters(clustered: DataFrame) -> DataFrame:
    """Label per cluster from its mean velocity and margin against the medians over the clusters."""
    centroids = clustered.groupBy("cluster").agg(F.avg("sales_velocity").alias("velocity"), F.avg("gross_margin").alias("margin"))
    medians = centroids.agg(F.percentile("velocity", F.lit(0.5)).alias("mv"), F.percentile("margin", F.lit(0.5)).alias("mm"))
    return attach_row(centroids, medians).select("cluster", labels.cluster_label("velocity", "mv", "margin", "mm").alias("cluster_label"))


def describe_clusters(clustered: DataFrame) -> DataFrame:
    """Report rows, by label and then by velocity."""
    return (
        clustered.join(label_clusters(clustered), "cluster").select(
            "sku_id", F.col("cluster").alias("cluster_id"), "cluster_label", F.round("sales_velocity", 2).alias("sales_velocity"),
            F.round("gross_margin", 2).alias("gross_margin"), F.col("total_volume").cast("long").alias("total_volume"),
            labels.strategy("cluster_label").alias("recommended_strategy"))
        .orderBy("cluster_label", F.desc("sales_velocity"), "sku_id")
    )


def cluster_skus(matrix: DataFrame, n_clusters: int | None = 4, features=None, seed: int = 42) -> DataFrame:
    """Matrix rows with their cluster number; ``n_clusters=None`` picks k by silhouette.

    The matrix is written once: scaler, components and K-means each read it again.
    """
    matrix = stage(matrix, "matrix")
    if matrix.isEmpty():
        return matrix.withColumns({"features": F.array().cast("array<double>"), "cluster": F.lit(0)})
    columns = fx.pick_columns(matrix, features, MATRIX_COLUMNS, ALIASES)
    scaled, _ = standardize(matrix, columns)
    reduced = principal_components(scaled, "scaled", len(columns))
    k = n_clusters or find_optimal_k(reduced, seed=seed)
    return kmeans(reduced, k, seed).select(*matrix.columns, "features", "cluster")


def sku_clusters(matrix: DataFrame, n_clusters: int | None = 4, features=None) -> DataFrame:
    return describe_clusters(cluster_skus(matrix, n_clusters, features))
