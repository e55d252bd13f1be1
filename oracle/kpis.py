"""Restock and indicator statements."""


def _restock(z: str) -> str:
    return f"""
WITH demand AS (SELECT sku_id, region, avg(sales_qty) AS ad, stddev_samp(sales_qty) AS sd, sum(sales_qty)*4 AS an
  FROM sales WHERE date >= (SELECT d FROM as_of_day)-90 GROUP BY 1,2),
b AS (SELECT i.sku_id, i.region, p.category, coalesce(i.quantity_on_hand,0) AS stock,
  coalesce(nullif(i.lead_time_days,0),7) AS lead, coalesce(nullif(i.unit_cost_inr,0),100) AS uc,
  coalesce(nullif(ad,0),1) AS ad, coalesce(nullif(sd,0),0.2e0*coalesce(nullif(ad,0),1)) AS sd,
  coalesce(nullif(an,0),365*coalesce(nullif(ad,0),1)) AS an
  FROM inventory_daily i JOIN products p ON p.sku_id=i.sku_id AND p.is_active JOIN demand d ON d.sku_id=i.sku_id AND d.region=i.region
  WHERE i.date=(SELECT d FROM as_of_day)-1),
c AS (SELECT *, greatest(0,CAST(ceil({z}*sd*sqrt(lead)) AS BIGINT)) AS ss,
  greatest(1,CAST(round_even(sqrt(2e0*an*500/(uc*0.25e0)),0) AS BIGINT)) AS q, round(stock/ad,1) AS dos FROM b),
e AS (SELECT *, greatest(0,CAST(ceil(ad*lead+ss) AS BIGINT)) AS rop,
  round(least(1e0,greatest(0e0,exp(-dos/greatest(lead,1)))),4) AS risk,
  CASE WHEN dos<5 THEN 'critical' WHEN dos<14 THEN 'warning' ELSE 'healthy' END AS pri FROM c)
SELECT sku_id, region, category, stock AS current_stock, rop AS reorder_point,
  CASE WHEN stock<rop THEN greatest(q, rop-stock+ss) ELSE q END AS recommended_order_qty, q AS economic_order_qty,
  CAST(lead AS INT) AS lead_time_days, dos AS days_of_supply, risk AS stockout_risk_score, pri AS priority,
  round(q*uc,2) AS estimated_cost_inr, ss AS safety_stock, CAST(trunc(an) AS BIGINT) AS annual_demand_units,
  round(ad,1) AS avg_daily_demand FROM e"""


_ORDER = " ORDER BY CASE pri WHEN 'critical' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END, risk DESC, sku_id, region LIMIT "

KPIS = {
    "restock_plan": _restock("1.65e0") + _ORDER + "500",
    "restock_plan_99": _restock("2.33e0"),
    "restock_critical": _restock("1.65e0") + " WHERE pri='critical'" + _ORDER + "500",
    "restock_filtered": _restock("1.65e0")
    + " WHERE region='ASIA' AND pri='warning' AND category='Apparel'" + _ORDER + "20",
    "stockout_risk_summary": """
WITH dd AS (SELECT sku_id, region, avg(sales_qty) AS a FROM sales WHERE date >= (SELECT d FROM as_of_day)-30 GROUP BY 1,2)
SELECT i.region, count(*) FILTER (WHERE quantity_on_hand/nullif(a,0) < 5) AS critical_count,
  count(*) FILTER (WHERE quantity_on_hand/nullif(a,0) BETWEEN 5 AND 14) AS warning_count,
  count(*) FILTER (WHERE quantity_on_hand/nullif(a,0) > 14) AS healthy_count
FROM inventory i JOIN dd USING (sku_id, region) WHERE i.snapshot_date=(SELECT d FROM as_of_day)-1 GROUP BY 1""",
    "sku_daily_kpis": "SELECT * FROM kpi",
    "regional_daily_kpis": "SELECT * FROM region_daily",
    "views_after_refresh": "SELECT * FROM region_daily WHERE date > (SELECT d FROM as_of_day) - 200",
    "inventory_two_days": "SELECT sku_id, warehouse_id, snapshot_date, quantity_on_hand FROM inventory",
    "regional_kpis": """
WITH rd AS (SELECT region, date, sum(actual_sales) AS ts, sum(predicted_demand) AS tp, avg(mape) AS m, sum(stockout_events) AS so,
  sum(overstock_events) AS oo, round((1-sum(stockout_events)/CAST(count(*) AS DOUBLE))*100,2) AS fr FROM kpi
  WHERE date BETWEEN (SELECT d FROM as_of_day)-30 AND (SELECT d FROM as_of_day) GROUP BY 1,2)
SELECT region, CAST(sum(ts) AS BIGINT) AS total_sales, sum(tp) AS predicted_demand, round(avg(m),6) AS avg_mape,
  round(avg(100-m),6) AS forecast_accuracy_pct, CAST(sum(so) AS BIGINT) AS stockout_events,
  CAST(sum(oo) AS BIGINT) AS overstock_events, round(avg(fr),6) AS fulfillment_rate_pct FROM rd GROUP BY 1""",
    "portfolio_kpis": """
WITH k AS (SELECT * FROM kpi WHERE date >= (SELECT d FROM as_of_day)-30),
tot AS (SELECT avg(mape) AS m, sum(CASE WHEN predicted_demand IS NOT NULL THEN abs(actual_sales-predicted_demand) END)*100/
  sum(CASE WHEN predicted_demand IS NOT NULL THEN actual_sales END) AS w, sum(stockout_events) AS s,
  (1-sum(stockout_events)/CAST(count(*) AS DOUBLE))*100 AS f FROM k),
cogs AS (SELECT sum(sales_qty*unit_cost_inr) AS c FROM sales JOIN products USING (sku_id) WHERE date >= (SELECT d FROM as_of_day)-29),
val AS (SELECT sum(a) AS v FROM (SELECT region, avg(v) AS a FROM (SELECT region, snapshot_date, sum(quantity_on_hand*unit_cost_inr) AS v
  FROM inventory WHERE snapshot_date >= (SELECT d FROM as_of_day)-29 GROUP BY 1,2) GROUP BY 1)),
dem AS (SELECT sku_id, region, avg(sales_qty) AS a FROM sales WHERE date >= (SELECT d FROM as_of_day)-29 GROUP BY 1,2),
sav AS (SELECT sum(greatest(0, a*30 - greatest(1, round_even(sqrt(2e0*a*365*500/(unit_cost_inr*0.25e0)),0)))/2*unit_cost_inr*0.25e0*30/365) AS s
  FROM dem JOIN products USING (sku_id)),
cov AS (SELECT avg(CASE WHEN quantity_on_hand>=sales_qty THEN 1e0 ELSE 0e0 END)*100 AS c FROM sales s LEFT JOIN inventory_daily i
  ON s.sku_id=i.sku_id AND s.region=i.region AND s.date=i.date WHERE s.date >= (SELECT d FROM as_of_day)-29),
ts AS (SELECT date, sales_qty, avg(sales_qty) OVER w AS m, stddev_samp(sales_qty) OVER w AS sd, count(*) OVER w AS n FROM sales
  WINDOW w AS (PARTITION BY sku_id, region ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)),
an AS (SELECT count(*) AS n FROM ts WHERE n>=7 AND abs(sales_qty-m)>2*sd AND date >= (SELECT d FROM as_of_day)-30)
SELECT round(tot.m,4) AS avg_mape, round(tot.w,4) AS weighted_mape, CAST(tot.s AS BIGINT) AS stockout_events_total,
  round(tot.f,4) AS fulfillment_rate, round(cogs.c/val.v*365/30,4) AS inventory_turnover, round(sav.s,4) AS overstock_cost_saved_inr,
  round(cov.c,4) AS demand_coverage_pct, an.n AS anomalies_detected FROM tot, cogs, val, sav, cov, an""",
    "inventory_turnover": """
WITH cg AS (SELECT region, sum(sales_qty*unit_cost_inr) AS cogs FROM sales JOIN products USING (sku_id)
  WHERE date >= (SELECT d FROM as_of_day)-29 GROUP BY 1),
v AS (SELECT region, avg(v) AS av FROM (SELECT region, snapshot_date, sum(quantity_on_hand*unit_cost_inr) AS v FROM inventory
  WHERE snapshot_date >= (SELECT d FROM as_of_day)-29 GROUP BY 1,2) GROUP BY 1)
SELECT region, round(cogs,4) AS cogs, round(av,4) AS avg_value, round(cogs/av*365/30,4) AS inventory_turnover FROM cg JOIN v USING (region)""",
    "demand_coverage": """
SELECT s.region, count(*) AS demand_events, round(avg(CASE WHEN quantity_on_hand>=sales_qty THEN 1e0 ELSE 0e0 END)*100,6) AS demand_coverage_pct
FROM sales s LEFT JOIN inventory_daily i ON s.sku_id=i.sku_id AND s.region=i.region AND s.date=i.date
WHERE s.date >= (SELECT d FROM as_of_day)-29 GROUP BY 1""",
    "overstock_saving": """
WITH dem AS (SELECT sku_id, region, avg(sales_qty) AS a FROM sales WHERE date >= (SELECT d FROM as_of_day)-29 GROUP BY 1,2)
SELECT region, round(sum(greatest(0, a*30 - greatest(1, round_even(sqrt(2e0*a*365*500/(unit_cost_inr*0.25e0)),0)))/2*unit_cost_inr*0.25e0*30/365),4)
  AS overstock_cost_saved_inr FROM dem JOIN products USING (sku_id) GROUP BY 1""",
    "stockout_reduction": """
WITH x AS (SELECT region, sum(CASE WHEN date > (SELECT d FROM as_of_day)-30 THEN stockout_events ELSE 0 END) AS c,
  sum(CASE WHEN date <= (SELECT d FROM as_of_day)-30 THEN stockout_events ELSE 0 END) AS b FROM kpi
  WHERE date > (SELECT d FROM as_of_day)-60 GROUP BY 1)
SELECT region, CAST(c AS BIGINT) AS current_stockouts, CAST(b AS BIGINT) AS baseline_stockouts,
  round((b-c)/nullif(CAST(b AS DOUBLE),0)*100,6) AS stockout_reduction_pct FROM x""",
    "wape_bias": """
SELECT region, round(sum(abs(actual_sales-predicted_demand))/CAST(sum(actual_sales) AS DOUBLE)*100,6) AS wape,
  round(avg(predicted_demand-actual_sales),6) AS bias FROM kpi WHERE predicted_demand IS NOT NULL GROUP BY 1""",
    "monthly_accuracy": """
WITH m AS (SELECT CAST(date_trunc('month',date) AS DATE) AS month, CAST(sum(CASE WHEN predicted_demand IS NOT NULL THEN actual_sales END) AS BIGINT) AS actual,
  sum(predicted_demand) AS predicted FROM kpi GROUP BY 1)
SELECT month, actual, round(predicted,6) AS predicted, round(coalesce(CASE WHEN predicted IS NOT NULL AND actual<>0 THEN greatest(0,100-abs(actual-predicted)/CAST(actual AS DOUBLE)*100) END,0),6) AS accuracy_pct FROM m""",
    "regional_flags": """
WITH rd AS (SELECT region, date, avg(mape) AS m, sum(stockout_events) AS so FROM kpi
  WHERE date >= (SELECT d FROM as_of_day)-365 GROUP BY 1,2)
SELECT region, round(avg(100-m),6) AS forecast_accuracy_pct, CAST(sum(so) AS BIGINT) AS stockout_events,
  avg(100-m)>90 AS good_accuracy, sum(so)>30 AS many_stockouts FROM rd GROUP BY 1""",
    "return_rates": "SELECT sku_id, round(sum(returns_qty)/CAST(sum(sales_qty) AS DOUBLE)*100,6) AS return_rate_pct FROM sales GROUP BY 1",
    "views_incremental": "SELECT * FROM region_daily",
    "months_incremental": """
SELECT region, strftime(date,'%Y-%m') AS part_month, count(*) AS rows, CAST(sum(actual_sales) AS BIGINT) AS total_sales, round(sum(predicted_demand),6) AS total_predicted_demand,
  round(avg(mape),6) AS avg_mape, CAST(sum(stockout_events) AS BIGINT) AS stockout_events, CAST(sum(overstock_events) AS BIGINT) AS overstock_events FROM kpi GROUP BY 1,2""",
    "ingested_pos": """
WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_shipdate AS DATE) AS date, l_tax=0.08e0 AS bad, CAST(l_quantity AS BIGINT) AS q,
  CASE WHEN l_returnflag='R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS b
  FROM lineitem JOIN part ON l_partkey=p_partkey JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey)
SELECT date, count(*) FILTER (NOT bad) AS lines, CAST(coalesce(sum(q) FILTER (NOT bad),0) AS BIGINT) AS sales_qty, CAST(coalesce(sum(b) FILTER (NOT bad),0) AS BIGINT) AS returns_qty,
  count(*) FILTER (bad) AS refused FROM l GROUP BY 1""",
    "ingested_competitor": """
WITH p AS (SELECT p_brand, r_name, CAST(l_shipdate AS DATE) AS date, max(floor(l_extendedprice*100+0.5e0))/100 AS price
  FROM lineitem JOIN part ON l_partkey=p_partkey JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey GROUP BY 1,2,3)
SELECT r_name AS competitor, count(*) AS prices, round(min(price),2) AS lowest, round(max(price),2) AS highest FROM p GROUP BY 1""",
}
