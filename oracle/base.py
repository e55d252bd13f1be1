"""The retail tables as SQL over the supplied order tables, in dependency order."""

PROMO_VALUES = """
('P1','Everything week','discount',10.0,DATE '1996-03-01',DATE '1996-03-07',NULL,NULL),
('P2','Brand pair','bogo',25.0,DATE '1997-06-01',DATE '1997-06-30',['Brand#1','Brand#2'],NULL),
('P3','Asia month','discount',15.0,DATE '1998-09-01',DATE '1998-09-30',NULL,['ASIA']),
('P4','Targeted','bundle',20.0,DATE '1999-02-01',DATE '1999-03-31',['Brand#3','Brand#4','Brand#5'],['EUROPE','AFRICA']),
('P5','One day','discount',30.0,DATE '2000-08-15',DATE '2000-08-15',NULL,NULL),
('P6','Overlap A','loyalty',5.0,DATE '2001-01-10',DATE '2001-02-10',['Brand#7'],NULL),
('P7','Overlap B','discount',12.5,DATE '2001-02-01',DATE '2001-02-28',['Brand#7','Brand#8'],['AMERICA']),
('P8','No sales','discount',50.0,DATE '2010-01-01',DATE '2010-01-31',['Brand#999'],NULL)
"""


def _sales(sku: str, join_part: str) -> str:
    return f"""
SELECT {sku} AS sku_id, r_name AS region, CAST(l_shipdate AS DATE) AS date,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sales_qty,
  CAST(sum(CAST(floor(l_extendedprice*(1e0-l_discount)*100+0.5e0) AS BIGINT)) AS DOUBLE)/100 AS revenue_inr,
  CAST(sum(CASE WHEN l_returnflag='R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS returns_qty,
  month(CAST(l_shipdate AS DATE))*100+day(CAST(l_shipdate AS DATE)) IN (101,126,815,1002,1225) AS is_holiday,
  max(l_discount) >= 0.09e0 AS is_promotion
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey {join_part}
GROUP BY 1,2,3"""


TABLES = {
    "regkey": "SELECT r_regionkey AS rk, r_name AS region FROM region",
    "sales": _sales("p_brand", "JOIN part ON l_partkey=p_partkey"),
    "part_sales": _sales("'SKU-'||l_partkey", ""),
    "as_of_day": "SELECT max(date) AS d FROM sales",
    "products": """
SELECT sku_id, product_name, ['Electronics','Apparel','Grocery','Home & Kitchen','Sports'][bn%5+1] AS category,
  cost/100 AS unit_cost_inr, price/100 AS unit_price_inr, bn%12<>0 AS is_active FROM (
SELECT p_brand AS sku_id, min(p_name) AS product_name, CAST(regexp_extract(p_brand,'[0-9]+') AS BIGINT) AS bn,
  floor(avg(floor(p_retailprice*100+0.5e0))*0.6e0+0.5e0) AS cost,
  floor(avg(floor(p_retailprice*100+0.5e0))+0.5e0) AS price
FROM part GROUP BY p_brand)""",
    "part_products": """
SELECT 'SKU-'||p_partkey AS sku_id, p_name AS product_name,
  ['Electronics','Apparel','Grocery','Home & Kitchen','Sports'][p_partkey%5+1] AS category,
  floor(p_retailprice*60+0.5e0)/100 AS unit_cost_inr, floor(p_retailprice*100+0.5e0)/100 AS unit_price_inr,
  p_partkey%12<>0 AS is_active FROM part""",
    "weather": """
SELECT region, date, ((dayofyear(date)*7 + rk*13) % 41)/1e1 - 2e0 AS score
FROM (SELECT DISTINCT region, date FROM sales) JOIN regkey USING (region)""",
    "competitor": """
SELECT p_brand AS sku_id, CAST(l_shipdate AS DATE) AS date,
  CAST((CAST(floor(l_tax*100+0.5e0) AS BIGINT)-4)*5 AS DOUBLE) AS price_delta_pct
FROM lineitem JOIN part ON l_partkey=p_partkey WHERE l_linenumber=7""",
    "competitor_daily": "SELECT sku_id, date, avg(price_delta_pct) AS price_delta_pct FROM competitor GROUP BY 1,2",
    "series": """
SELECT sku_id, region, rk, CAST(regexp_extract(sku_id,'[0-9]+') AS BIGINT) AS bn
FROM (SELECT DISTINCT sku_id, region FROM sales) JOIN regkey USING (region)""",
    "inventory": """
SELECT sku_id, 'WH-'||rk||'-'||w AS warehouse_id, region, sd AS snapshot_date,
  CASE WHEN (bn*7+rk*11+dayofyear(sd))%29=0 THEN 0 ELSE (bn*37+rk*53+dayofyear(sd)*17+w*101)%400 END AS quantity_on_hand,
  60+(bn*10)%140 AS reorder_point, 2+bn%13 AS lead_time_days, unit_cost_inr
FROM series JOIN (SELECT CAST(unnest(generate_series(d - INTERVAL 399 DAY, CAST(d AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS sd FROM as_of_day) ON true
JOIN (SELECT unnest([0,1]) AS w) ON true JOIN products USING (sku_id)""",
    "inventory_daily": """
SELECT sku_id, region, snapshot_date AS date, CAST(sum(quantity_on_hand) AS BIGINT) AS quantity_on_hand,
  max(reorder_point) AS reorder_point, max(lead_time_days) AS lead_time_days, max(unit_cost_inr) AS unit_cost_inr
FROM inventory GROUP BY 1,2,3""",
    "forecasts": """
SELECT sku_id, region, CAST(date - lead AS DATE) AS forecast_date, date AS target_date,
  CAST(greatest(0, sales_qty + (bn+rk+dayofyear(date)*(1+2*m)+lead)%(11+6*m) - (5+3*m)) AS DOUBLE) AS predicted_qty,
  CASE m WHEN 0 THEN 'ensemble' ELSE 'naive' END AS model_name, 'v'||lead AS model_version,
  CASE WHEN dayofyear(date)%2=0 THEN round(abs(sales_qty - CAST(greatest(0, sales_qty + (bn+rk+dayofyear(date)*(1+2*m)+lead)%(11+6*m) - (5+3*m)) AS DOUBLE))/nullif(CAST(sales_qty AS DOUBLE),0)*100,3) END AS realized_mape
FROM sales JOIN series USING (sku_id, region) JOIN (SELECT unnest([1,7]) AS lead) ON true
JOIN (SELECT unnest([0,1]) AS m) ON true
WHERE date > (SELECT d FROM as_of_day) - 400""",
    "forecast_latest": """
SELECT sku_id, region, target_date, model_name, max_by(predicted_qty, forecast_date) AS predicted_qty
FROM forecasts GROUP BY 1,2,3,4""",
    "promos": f"SELECT * FROM (VALUES {PROMO_VALUES}) t(promo_id,name,promo_type,discount_pct,start_date,end_date,applicable_skus,applicable_regions)",
    "model_versions": """
SELECT model_name, CAST(year(target_date)*4+quarter(target_date)-1 AS INT) AS version,
  round(avg(abs(predicted_qty-sales_qty)/nullif(CAST(sales_qty AS DOUBLE),0)*100),3) AS avg_mape,
  round(sqrt(avg((predicted_qty-sales_qty)*(predicted_qty-sales_qty))),2) AS avg_rmse,
  CASE WHEN CAST(year(target_date)*4+quarter(target_date)-1 AS INT) = (SELECT year(d-399)*4+quarter(d-399)-1 FROM as_of_day)
       THEN 'Production' ELSE 'Staging' END AS stage
FROM forecasts f JOIN sales s ON f.sku_id=s.sku_id AND f.region=s.region AND f.target_date=s.date GROUP BY 1,2""",
    "kpi": """
SELECT s.sku_id, s.region, s.date, s.sales_qty AS actual_sales, f.predicted_qty AS predicted_demand,
  round(abs(s.sales_qty-f.predicted_qty)/nullif(CAST(s.sales_qty AS DOUBLE),0)*100,3) AS mape,
  CASE WHEN i.quantity_on_hand=0 THEN 1 ELSE 0 END AS stockout_events,
  CASE WHEN i.quantity_on_hand>2*i.reorder_point THEN 1 ELSE 0 END AS overstock_events,
  coalesce(i.quantity_on_hand,0) AS stock_level, CAST(coalesce(i.reorder_point,0) AS INT) AS reorder_point, s.is_promotion
FROM sales s LEFT JOIN forecast_latest f ON f.sku_id=s.sku_id AND f.region=s.region AND f.target_date=s.date AND f.model_name='ensemble'
LEFT JOIN inventory_daily i ON i.sku_id=s.sku_id AND i.region=s.region AND i.date=s.date""",
    "region_daily": """
SELECT region, date, CAST(sum(actual_sales) AS BIGINT) AS total_sales, sum(predicted_demand) AS total_predicted_demand,
  round(avg(mape),8) AS avg_mape, round(100-avg(mape),8) AS forecast_accuracy_pct,
  CAST(sum(stockout_events) AS BIGINT) AS stockout_events, CAST(sum(overstock_events) AS BIGINT) AS overstock_events,
  round((1-sum(stockout_events)/CAST(count(*) AS DOUBLE))*100,2) AS fulfillment_rate
FROM kpi GROUP BY 1,2""",
}
