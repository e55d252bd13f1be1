"""Declared schemas of the retail tables.

Counts are 64-bit where the fact may be summed over many source rows. Money and rates
are decimals at rest and doubles in computation.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DateType(), T.BooleanType()
SERIES_KEYS = ["sku_id", "region"]
FACT_KEYS = ["sku_id", "region", "date"]


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, null) for n, t, null in fields])


REGIONS = _struct(
    ("region_id", I, False), ("name", S, False), ("state", S, True), ("country", S, True),
    ("lat", T.DecimalType(9, 6), True), ("lng", T.DecimalType(9, 6), True), ("tier", T.ShortType(), True),
)
PRODUCTS = _struct(
    ("sku_id", S, False), ("product_name", S, False), ("category", S, False), ("subcategory", S, True),
    ("brand", S, True), ("unit_cost_inr", T.DecimalType(10, 2), False),
    ("unit_price_inr", T.DecimalType(10, 2), False), ("weight_kg", T.DecimalType(6, 3), True),
    ("is_active", B, True),
)
WAREHOUSES = _struct(
    ("warehouse_id", S, False), ("name", S, True), ("region", S, True), ("capacity_units", I, True),
    ("lat", T.DecimalType(9, 6), True), ("lng", T.DecimalType(9, 6), True),
)
PROMOTIONS = _struct(
    ("promo_id", S, False), ("name", S, False), ("promo_type", S, True),
    ("discount_pct", T.DecimalType(5, 2), True), ("start_date", D, False), ("end_date", D, False),
    ("applicable_skus", T.ArrayType(S), True), ("applicable_regions", T.ArrayType(S), True),
)
SALES = _struct(
    ("sku_id", S, False), ("region", S, False), ("date", D, False), ("sales_qty", L, False),
    ("revenue_inr", T.DecimalType(14, 2), False), ("returns_qty", L, True), ("is_holiday", B, True),
    ("is_promotion", B, True), ("promo_id", S, True), ("weather_score", T.DecimalType(6, 3), True),
)
INVENTORY = _struct(
    ("sku_id", S, False), ("warehouse_id", S, True), ("region", S, True), ("snapshot_date", D, False),
    ("quantity_on_hand", I, False), ("quantity_on_order", I, True), ("quantity_reserved", I, True),
    ("reorder_point", I, True), ("lead_time_days", T.ShortType(), True),
    ("unit_cost_inr", T.DecimalType(10, 2), True),
)
FORECASTS = _struct(
    ("sku_id", S, False), ("region", S, False), ("forecast_date", D, False), ("target_date", D, False),
    ("predicted_qty", T.DecimalType(12, 1), False), ("lower_bound", T.DecimalType(12, 1), True),
    ("upper_bound", T.DecimalType(12, 1), True), ("model_name", S, True), ("model_version", S, True),
    ("mape", T.DecimalType(6, 3), True), ("realized_mape", T.DecimalType(6, 3), True),
)
ANOMALIES = _struct(
    ("sku_id", S, False), ("region", S, False), ("event_date", D, False),
    ("actual_value", T.DecimalType(12, 1), True), ("expected_value", T.DecimalType(12, 1), True),
    ("anomaly_score", T.DecimalType(6, 4), False), ("direction", S, True), ("probable_cause", S, True),
    ("resolved", B, True), ("resolved_by", S, True), ("resolved_at", T.TimestampType(), True), ("notes", S, True),
)
WEATHER = _struct(
    ("region", S, False), ("date", D, False), ("score", T.DecimalType(5, 3), True),
    ("temp_c", T.DecimalType(5, 2), True), ("condition", S, True),
)
COMPETITOR = _struct(
    ("sku_id", S, True), ("date", D, False), ("competitor_name", S, True),
    ("price_delta_pct", T.DecimalType(7, 3), True), ("source_url", S, True),
)
RETURN_RATES = _struct(("sku_id", S, False), ("return_rate_pct", T.DecimalType(6, 3), True), ("computed_date", D, True))
PROMO_LIFT = _struct(("sku_id", S, False), ("promo_id", S, False), ("lift_ratio", T.DecimalType(7, 4), True))
MODEL_VERSIONS = _struct(
    ("model_name", S, False), ("version", I, False), ("stage", S, True), ("mlflow_run_id", S, True),
    ("avg_mape", T.DecimalType(6, 3), True), ("avg_rmse", T.DecimalType(10, 2), True),
    ("promoted_at", T.TimestampType(), True), ("promoted_by", S, True),
)
FEATURE_STORE = _struct(
    ("sku_id", S, False), ("region", S, False), ("date", D, False), ("sales_qty", L, True),
    *[(f"lag_{n}", T.DecimalType(12, 2), True) for n in (7, 14, 21, 28)],
    ("rolling_mean_7", T.DecimalType(12, 4), True), ("rolling_mean_28", T.DecimalType(12, 4), True),
    ("rolling_std_7", T.DecimalType(12, 4), True), ("day_of_week", T.ShortType(), True),
    ("month", T.ShortType(), True), ("is_holiday", B, True), ("is_promotion", B, True),
    ("weather_score", T.DecimalType(6, 3), True), ("competitor_price_delta", T.DecimalType(7, 3), True),
    ("yoy_ratio", T.DecimalType(8, 4), True),
)

TABLES = {
    "regions": REGIONS, "products": PRODUCTS, "warehouses": WAREHOUSES, "promotions": PROMOTIONS,
    "sku_daily_sales": SALES, "inventory_snapshots": INVENTORY, "forecast_outputs": FORECASTS,
    "anomaly_events": ANOMALIES, "weather_scores": WEATHER, "competitor_events": COMPETITOR,
    "sku_return_rates": RETURN_RATES, "promo_lift_summary": PROMO_LIFT, "model_versions": MODEL_VERSIONS,
    "feature_store": FEATURE_STORE,
}

#: Column defaults declared for the tables (used where a loaded value is missing).
COLUMN_DEFAULTS = {
    "regions": {"country": "IN", "tier": 1},
    "products": {"unit_cost_inr": 0, "unit_price_inr": 0, "is_active": True},
    "sku_daily_sales": {"sales_qty": 0, "revenue_inr": 0, "returns_qty": 0, "is_holiday": False, "is_promotion": False},
    "inventory_snapshots": {"quantity_on_hand": 0, "quantity_on_order": 0, "quantity_reserved": 0},
    "forecast_outputs": {"model_name": "ensemble"},
    "anomaly_events": {"resolved": False},
    "model_versions": {"stage": "Staging"},
    "feature_store": {"is_holiday": False, "is_promotion": False},
}

#: Payload of each event stream (JSON text in the ``value`` column of the topic).
EVENT_SCHEMAS = {
    "sales-events": "event_id BIGINT, sku_id STRING, region STRING, qty BIGINT, amount DOUBLE, ts TIMESTAMP",
    "inventory-updates": "sku_id STRING, warehouse_id STRING, region STRING, quantity_on_hand INT, ts TIMESTAMP",
    "forecast-events": "sku_id STRING, region STRING, model STRING, horizon_days INT, mape DOUBLE, ts TIMESTAMP",
    "anomaly-alerts": "sku_id STRING, region STRING, date DATE, actual_value DOUBLE, anomaly_score DOUBLE",
    "promotions": "promo_id STRING, name STRING, promo_type STRING, discount_pct DOUBLE, start_date DATE, "
                  "end_date DATE, applicable_skus ARRAY<STRING>, applicable_regions ARRAY<STRING>",
}
