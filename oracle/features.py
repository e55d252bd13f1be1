"""Feature statements."""


def _feature_rows(source: str, short: int, long: int) -> str:
    return f"""
, f AS (SELECT x.*, coalesce(w.score,0) AS weather_score, coalesce(c.price_delta_pct,0) AS competitor_price_delta
  FROM {source} x LEFT JOIN weather w ON w.region=x.region AND w.date=x.date
  LEFT JOIN competitor_daily c ON c.sku_id=x.sku_id AND c.date=x.date),
g AS (SELECT f.*, lag(sales_qty,7) OVER s AS lag_7, lag(sales_qty,14) OVER s AS lag_14, lag(sales_qty,21) OVER s AS lag_21,
  lag(sales_qty,28) OVER s AS lag_28,
  CASE WHEN count(*) OVER w7>={short} THEN avg(sales_qty) OVER w7 END AS m7,
  CASE WHEN count(*) OVER w28>={long} THEN avg(sales_qty) OVER w28 END AS m28,
  CASE WHEN count(*) OVER w7>={short} THEN stddev_samp(sales_qty) OVER w7 END AS s7 FROM f
  WINDOW s AS (PARTITION BY sku_id, region ORDER BY date),
  w7 AS (PARTITION BY sku_id, region ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
  w28 AS (PARTITION BY sku_id, region ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
SELECT g.sku_id, g.region, g.date, g.sales_qty, lag_7, lag_14, lag_21, lag_28, round(m7,6) AS rolling_mean_7, round(m28,6) AS rolling_mean_28,
  round(s7,6) AS rolling_std_7, CAST(isodow(g.date)-1 AS INT) AS day_of_week, CAST(month(g.date) AS INT) AS month, g.is_holiday, g.is_promotion,
  round(weather_score,6) AS weather_score, round(competitor_price_delta,6) AS competitor_price_delta,
  round(g.sales_qty/CAST(y.sales_qty+1 AS DOUBLE),6) AS yoy_ratio
FROM g LEFT JOIN {source} y ON y.sku_id=g.sku_id AND y.region=g.region AND y.date=g.date-365
WHERE lag_7 IS NOT NULL AND m7 IS NOT NULL"""




def _recent(day: str = "(SELECT d FROM as_of_day)") -> str:
    return ("WITH base AS MATERIALIZED (SELECT sku_id, region, date, sales_qty, is_holiday, is_promotion FROM sales "
            f"WHERE date BETWEEN {day}-400 AND {day})")


_RECENT = _recent()
_EARLIER = "(SELECT d-5 FROM as_of_day)"
DENSE = """dense AS MATERIALIZED (SELECT c.sku_id, c.region, c.date, coalesce(b.sales_qty,0) AS sales_qty,
  month(c.date)*100+day(c.date) IN (101,126,815,1002,1225) AS is_holiday, coalesce(b.is_promotion,false) AS is_promotion
  FROM (SELECT sku_id, region, CAST(first + CAST(k AS INT) AS DATE) AS date FROM (SELECT sku_id, region, min(date) AS first, max(date)-min(date) AS span
        FROM base GROUP BY 1,2) JOIN (SELECT unnest(generate_series(0,400)) AS k) ON k<=span) c
  LEFT JOIN base b ON b.sku_id=c.sku_id AND b.region=c.region AND b.date=c.date)"""

FEATURES = {
    "features_rows": _RECENT + _feature_rows("base", 1, 1),
    "features_calendar": _RECENT + ", " + DENSE + _feature_rows("dense", 7, 28),
    "features_two_runs": f"""
SELECT sku_id, region, date, sales_qty, lag_7, lag_28, is_promotion FROM ({_recent()}{_feature_rows("base", 1, 1)}) WHERE date > (SELECT d FROM as_of_day)-7
UNION ALL SELECT sku_id, region, date, sales_qty, lag_7, lag_28, is_promotion FROM ({_recent(_EARLIER)}{_feature_rows("base", 1, 1)}) WHERE date > {_EARLIER}-7 AND date <= (SELECT d FROM as_of_day)-7""",
    "yoy_ratio": """
SELECT s.sku_id, s.region, s.date, s.sales_qty, round(s.sales_qty/CAST(y.sales_qty+1 AS DOUBLE),6) AS yoy_ratio
FROM sales s JOIN sales y ON y.sku_id=s.sku_id AND y.region=s.region AND y.date=s.date-365""",
    "forecaster_features": """
WITH g AS (SELECT sku_id, region, date, sales_qty, is_holiday, is_promotion AS promo_active,
  lag(sales_qty,7) OVER s AS lag_7, lag(sales_qty,14) OVER s AS lag_14, lag(sales_qty,21) OVER s AS lag_21, lag(sales_qty,28) OVER s AS lag_28,
  round(avg(sales_qty) OVER w7,6) AS rolling_mean_7, round(avg(sales_qty) OVER w28,6) AS rolling_mean_28,
  round(stddev_samp(sales_qty) OVER w7,6) AS rolling_std_7, CAST(isodow(date)-1 AS INT) AS day_of_week, CAST(month(date) AS INT) AS month,
  count(*) OVER w28 AS n FROM sales
  WINDOW s AS (PARTITION BY sku_id, region ORDER BY date),
  w7 AS (PARTITION BY sku_id, region ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
  w28 AS (PARTITION BY sku_id, region ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
SELECT * EXCLUDE (n) FROM g WHERE n=28""",
    "anomaly_features": """
WITH g AS (SELECT s.sku_id, s.region, s.date, CAST(sales_qty AS DOUBLE) AS daily_sales, CAST(isodow(s.date)-1 AS INT) AS day_of_week,
  CAST(month(s.date) AS INT) AS month, is_holiday, is_promotion, coalesce(w.score,0) AS weather_score, coalesce(c.price_delta_pct,0) AS competitor_price_delta,
  lag(sales_qty,7) OVER o AS lag_7, lag(sales_qty,28) OVER o AS lag_28, avg(sales_qty) OVER w7 AS m7, stddev_samp(sales_qty) OVER w7 AS s7,
  count(*) OVER w7 AS n7, count(*) OVER (PARTITION BY s.sku_id, s.region) AS series_rows
  FROM sales s LEFT JOIN weather w ON w.region=s.region AND w.date=s.date LEFT JOIN competitor_daily c ON c.sku_id=s.sku_id AND c.date=s.date
  WINDOW o AS (PARTITION BY s.sku_id, s.region ORDER BY s.date),
  w7 AS (PARTITION BY s.sku_id, s.region ORDER BY s.date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT g.sku_id, g.region, g.date, daily_sales, round(m7,6) AS rolling_mean_7, round(coalesce(s7,1),6) AS rolling_std_7, day_of_week, month,
  g.is_holiday, g.is_promotion, round(weather_score,6) AS weather_score, round(competitor_price_delta,6) AS competitor_price_delta, lag_7,
  round(coalesce(lag_28,m7),6) AS lag_28, round(coalesce(daily_sales/(y.sales_qty+1),1),6) AS yoy_ratio, series_rows
FROM g LEFT JOIN sales y ON y.sku_id=g.sku_id AND y.region=g.region AND y.date=g.date-365 WHERE n7>=3 AND lag_7 IS NOT NULL""",
    "two_sigma_flags": """
WITH t AS (SELECT sku_id, region, date, sales_qty, avg(sales_qty) OVER w AS m, stddev_samp(sales_qty) OVER w AS sd, count(*) OVER w AS n FROM sales
  WINDOW w AS (PARTITION BY sku_id, region ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
SELECT sku_id, region, date, sales_qty, round(m,6) AS band_mean, round(sd,6) AS band_std FROM t WHERE n>=7 AND abs(sales_qty-m)>2*sd""",
    "inventory_drop": """
WITH p AS (SELECT sku_id, region, date, quantity_on_hand, lag(quantity_on_hand) OVER (PARTITION BY sku_id, region ORDER BY date) AS prev FROM inventory_daily)
SELECT sku_id, region, date, quantity_on_hand, round(greatest(0,coalesce((prev-quantity_on_hand)/nullif(CAST(prev AS DOUBLE),0)*100,0)),6) AS inventory_drop_pct FROM p""",
}
