"""Stream statements: the same aggregates over the whole input, with no regard to watermarks."""

_EV = """
ev AS (SELECT event_id, ts, 'Brand#'||(1+CAST(json_extract_string(props,'$.k') AS BIGINT)%25) AS sku_id, region,
  1+CAST(json_extract_string(props,'$.k') AS BIGINT)%9 AS qty, value AS amount FROM events JOIN regkey ON rk=user_id%5 WHERE event_type='purchase'),
dy AS (SELECT sku_id, region, CAST(ts AS DATE) AS date, CAST(sum(qty) AS BIGINT) AS sales_qty, sum(amount) AS revenue, count(*) AS events FROM ev GROUP BY 1,2,3)"""

STREAMS = {
    "stream_daily_sales": "WITH " + _EV + " SELECT sku_id, region, date, sales_qty, round(revenue,4) AS revenue, events FROM dy",
    "stream_rolling_stats": "WITH " + _EV + """,
r AS (SELECT sku_id, region, CAST(date - CAST(k AS INT) AS DATE) AS from_date, sales_qty FROM dy JOIN (SELECT unnest(generate_series(0,6)) AS k) ON true)
SELECT sku_id, region, from_date, round(avg(sales_qty),6) AS rolling_mean_7, round(stddev_samp(sales_qty),6) AS rolling_std_7, count(*) AS days
FROM r GROUP BY 1,2,3""",
    "stream_enriched_sales": "WITH " + _EV + """
SELECT sku_id, region, date, sales_qty, category, unit_cost_inr, round(sales_qty*unit_cost_inr,4) AS cogs FROM dy JOIN products USING (sku_id)""",
    "stream_alerts": "WITH " + _EV + """,
h AS (SELECT sku_id, region, avg(sales_qty) AS m, stddev_samp(sales_qty) AS s FROM dy WHERE date < (SELECT max(date) FROM dy)-6 GROUP BY 1,2),
z AS (SELECT sku_id, region, date, CAST(sales_qty AS DOUBLE) AS actual_value, coalesce(1-exp(-((sales_qty-m)/nullif(s,0))*((sales_qty-m)/nullif(s,0))/2),0) AS sc FROM dy JOIN h USING (sku_id, region) WHERE date >= (SELECT max(date) FROM dy)-6)
SELECT sku_id, region, date, actual_value, round(sc,6) AS anomaly_score FROM z WHERE sc>0.9e0""",
    "stream_state_alerts": "WITH " + _EV + """,
b AS (SELECT sku_id, region, date, sales_qty, avg(sales_qty) OVER w AS m, stddev_samp(sales_qty) OVER w AS s, count(*) OVER w AS n FROM dy
  WINDOW w AS (PARTITION BY sku_id, region ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, 1-exp(-((sales_qty-m)/s)*((sales_qty-m)/s)/2) AS sc FROM b WHERE n>=3 AND s>0)
SELECT sku_id, region, date, CAST(sales_qty AS DOUBLE) AS actual_value, round(m,6) AS mean_qty, round(s,6) AS std_qty, round(sc,6) AS anomaly_score FROM z WHERE sc>0.9e0""",
    "stream_forecast_monitoring": """
WITH e AS (SELECT model_name AS model, target_date, abs(sales_qty-predicted_qty)/nullif(CAST(sales_qty AS DOUBLE),0)*100 AS mape FROM forecasts f
  JOIN sales s ON s.sku_id=f.sku_id AND s.region=f.region AND s.date=f.target_date),
k AS (SELECT *, CAST(DATE '1970-01-01' + CAST(floor((target_date - DATE '1970-01-01')/7e0)*7 AS INT) AS DATE) AS week FROM e)
SELECT model, week, round(avg(mape),6) AS avg_mape, count(*) AS forecasts FROM k GROUP BY 1,2""",
    "stream_current_stock": """
SELECT sku_id, warehouse_id, snapshot_date AS ts, CAST(quantity_on_hand AS INT) AS quantity_on_hand FROM inventory WHERE snapshot_date=(SELECT d FROM as_of_day)""",
    "event_json": "WITH " + _EV + " SELECT event_id, sku_id, region, qty, amount, epoch_us(ts) AS ts_micros FROM ev",
}
