"""Sales anomalies: forest score, scaling per series, direction and probable cause."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels
from ..functions import scalar as fx
from ..schemas import FACT_KEYS, SERIES_KEYS
from ..session import attach_row, stage
from . import isolation_forest as forest
from .features import DETECTOR_FEATURES, detector_features, enrich, inventory_drop
from .restock import inventory_by_region

THRESHOLD = 0.70
MIN_SERIES_ROWS = 14
HISTORY_DAYS = 400
EVENT_COLUMNS = ["sku_id", "region", "date", "actual_value", "expected_value", "anomaly_score", "direction", "probable_cause"]


def detection_rows(sales: DataFrame, weather: DataFrame, competitor: DataFrame, inventory: DataFrame, as_of,
                   days_back: int = 30, region: str | None = None, sku_id: str | None = None) -> DataFrame:
    """Detector features plus the stock drop of the day; enough history is read for the yearly ratio."""
    recent = fx.optional_equals(fx.trailing(sales, as_of, days_back + HISTORY_DAYS), region=region, sku_id=sku_id)
    stock_rows = fx.optional_equals(fx.trailing(inventory, as_of, days_back + HISTORY_DAYS, "snapshot_date"),
                                    region=region, sku_id=sku_id)
    drops = inventory_drop(inventory_by_region(stock_rows)).drop("quantity_on_hand")
    full = detector_features(enrich(recent, weather, competitor))
    return full.select(*FACT_KEYS, *DETECTOR_FEATURES).join(drops, FACT_KEYS, "left").na.fill({"inventory_drop_pct": 0.0})


def scale_scores(scored: DataFrame, scope: str = "series") -> DataFrame:
    """anomaly_score in [0, 1] from raw_score: min-max within each series, or over everything."""
    if scope == "series":
        w = Window.partitionBy(*SERIES_KEYS)
        return scored.withColumn("anomaly_score", labels.minmax_score("raw_score", F.min("raw_score").over(w), F.max("raw_score").over(w)))
    if scope == "global":
        bounds = scored.agg(F.min("raw_score").alias("_low"), F.max("raw_score").alias("_high"))
        return attach_row(scored, bounds).withColumn("anomaly_score", labels.minmax_score("raw_score", "_low", "_high")).drop("_low", "_high")
    raise ValueError("scope is 'series' or 'global'")


def score_events(rows: DataFrame, as_of, days_back: int = 30, min_score: float = THRESHOLD, scope: str = "series") -> DataFrame:
    """Events of the window from rows that carry ``raw_score``; series with fewer than 14 days are skipped."""
    size = F.count(F.lit(1)).over(Window.partitionBy(*SERIES_KEYS))
    window = fx.trailing(rows, as_of, days_back).withColumn("_n", size).filter(F.col("_n") >= MIN_SERIES_ROWS)
    actual, expected = F.col("daily_sales"), F.col("rolling_mean_7")
    return (
        scale_scores(window, scope).withColumn("direction", labels.direction(actual, expected))
        .withColumn("probable_cause", labels.probable_cause())
        .filter(F.col("anomaly_score") >= min_score)
        .select("sku_id", "region", fx.date_text("date").alias("date"), F.round(actual, 1).alias("actual_value"),
                F.round(expected, 1).alias("expected_value"), F.round("anomaly_score", 4).alias("anomaly_score"),
                "direction", "probable_cause")
        .orderBy(F.desc("anomaly_score"), "sku_id", "region", "date")
    )


def detect_anomalies(sales: DataFrame, weather: DataFrame, competitor: DataFrame, inventory: DataFrame, as_of, *,
                     days_back: int = 30, region: str | None = None, sku_id: str | None = None, min_score: float = THRESHOLD,
                     scope: str = "series", model: forest.Forest | None = None, n_trees: int = forest.N_TREES) -> DataFrame:
    """Scored events above ``min_score``. The forest is fitted on all series of the history unless given.

    The feature rows are written once: fitting and scoring both read them. ``region`` and ``sku_id`` choose
    what is returned; neither the forest nor a score depends on them.
    """
    asked = {"region": region, "sku_id": sku_id} if model is not None and scope == "series" else {}  # else all rows are needed
    rows = stage(detection_rows(sales, weather, competitor, inventory, as_of, days_back, **asked), "detector")
    if model is None:
        model = forest.fit_forest(rows, FACT_KEYS, DETECTOR_FEATURES, n_trees)
    scored = fx.trailing(rows, as_of, days_back)
    if scope == "series":
        scored = fx.optional_equals(scored, region=region, sku_id=sku_id)
    events = score_events(forest.score_forest(scored, model), as_of, days_back, min_score, scope)
    return fx.optional_equals(events, region=region, sku_id=sku_id)
