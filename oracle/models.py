"""Cluster and anomaly statements."""

from .monitoring import _expanded


def _matrix(sales: str, products: str, as_of: str, days: int, min_rows: int) -> str:
    return "WITH " + _expanded(28, 0).replace("JOIN sales s", f"JOIN {sales} s") + f""",
pl AS (SELECT sku_id, promo_id, avg(sales_qty) FILTER (WHERE phase='during')/nullif(avg(sales_qty) FILTER (WHERE phase='before'),0) AS lift FROM ex GROUP BY 1,2),
lf AS (SELECT sku_id, avg(lift) AS ps FROM pl GROUP BY 1),
rr AS (SELECT sku_id, sum(returns_qty)/CAST(sum(sales_qty) AS DOUBLE)*100 AS rr FROM {sales} GROUP BY 1),
pk AS (SELECT sku_id, max(q) AS peak FROM (SELECT sku_id, date_trunc('month',date) AS m, sum(sales_qty) AS q FROM {sales} WHERE date >= {as_of}-365 GROUP BY 1,2) GROUP BY 1),
b AS (SELECT s.sku_id, avg(sales_qty) AS v, avg((revenue_inr-unit_cost_inr*sales_qty)/nullif(revenue_inr,0)*100) AS gm, CAST(sum(sales_qty) AS BIGINT) AS tv,
  avg(revenue_inr/nullif(sales_qty,0)) AS aov FROM {sales} s JOIN {products} p ON p.sku_id=s.sku_id WHERE date >= {as_of}-{days} GROUP BY 1 HAVING count(*)>={min_rows}),
mx AS (SELECT b.sku_id, v AS sales_velocity, coalesce(gm,20) AS gross_margin, tv AS total_volume, coalesce(peak/nullif(v*30,0),1) AS seasonality_idx,
  coalesce(rr,0) AS return_rate, coalesce(ps,1) AS promo_sensitivity, aov AS avg_order_value
  FROM b LEFT JOIN pk ON pk.sku_id=b.sku_id LEFT JOIN rr ON rr.sku_id=b.sku_id LEFT JOIN lf ON lf.sku_id=b.sku_id)"""


_AS_OF = "(SELECT d FROM as_of_day)"
_ROUNDED = """ SELECT sku_id, round(sales_velocity,8) AS sales_velocity, round(gross_margin,6) AS gross_margin, total_volume, round(seasonality_idx,8) AS seasonality_idx,
  round(return_rate,8) AS return_rate, round(promo_sensitivity,8) AS promo_sensitivity, round(avg_order_value,6) AS avg_order_value FROM mx"""
_LABELS = _matrix("sales", "products", _AS_OF, 90, 30) + """,
cl AS (SELECT *, CAST(regexp_extract(sku_id,'[0-9]+') AS INT)%6 AS cluster FROM mx),
ce AS (SELECT cluster, avg(sales_velocity) AS v, avg(gross_margin) AS m FROM cl GROUP BY 1),
md AS (SELECT quantile_cont(v,0.5) AS mv, quantile_cont(m,0.5) AS mm FROM ce),
lb AS (SELECT cluster, CASE WHEN v>=mv AND m>=mm THEN 'Stars' WHEN m>=mm THEN 'Cash Cows' WHEN v>=mv THEN 'Volume Movers' ELSE 'Tail SKUs' END AS cluster_label FROM ce, md)"""

MODELS = {
    "sku_feature_matrix": _matrix("sales", "products", _AS_OF, 90, 30) + _ROUNDED,
    "sku_feature_matrix_part": _matrix("part_sales", "part_products", _AS_OF, 3650, 10) + _ROUNDED,
    "peak_month": """
SELECT sku_id, CAST(max(q) AS BIGINT) AS peak FROM (SELECT sku_id, date_trunc('month',date) AS m, sum(sales_qty) AS q FROM sales
WHERE date >= (SELECT d FROM as_of_day)-365 GROUP BY 1,2) GROUP BY 1""",
    "cluster_labels": _LABELS + """
SELECT sku_id, cluster AS cluster_id, cluster_label, round(sales_velocity,2) AS sales_velocity, round(gross_margin,2) AS gross_margin, total_volume,
CASE cluster_label WHEN 'Stars' THEN 'Premium placement · high service level · tighter safety stock'
 WHEN 'Cash Cows' THEN 'Long tail management · lower reorder frequency · premium pricing'
 WHEN 'Volume Movers' THEN 'Bulk ordering · warehouse efficiency · thin margin protection'
 ELSE 'Review for clearance · discontinue if margin negative' END AS recommended_strategy FROM cl JOIN lb USING (cluster)""",
    "cluster_distribution": _LABELS + """
SELECT cluster_label, count(sku_id) AS sku_count FROM (SELECT unnest(['Stars','Cash Cows','Volume Movers','Tail SKUs']) AS cluster_label)
LEFT JOIN (SELECT sku_id, cluster_label FROM cl JOIN lb USING (cluster)) USING (cluster_label) GROUP BY 1""",
    "anomaly_causes": """
WITH b AS (SELECT * FROM sales WHERE date >= (SELECT d FROM as_of_day)-580),
g AS (SELECT s.sku_id, s.region, s.date, s.is_holiday, s.is_promotion, CAST(sales_qty AS DOUBLE) AS a, coalesce(w.score,0) AS ws, coalesce(c.price_delta_pct,0) AS cp,
  lag(sales_qty,7) OVER o AS l7, avg(sales_qty) OVER w7 AS m7, coalesce(stddev_samp(sales_qty) OVER w7,1) AS s7, count(*) OVER w7 AS n7
  FROM b s LEFT JOIN weather w ON w.region=s.region AND w.date=s.date LEFT JOIN competitor_daily c ON c.sku_id=s.sku_id AND c.date=s.date
  WINDOW o AS (PARTITION BY s.sku_id, s.region ORDER BY s.date),
  w7 AS (PARTITION BY s.sku_id, s.region ORDER BY s.date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
d AS (SELECT sku_id, region, date, greatest(0,coalesce((prev-q)/nullif(CAST(prev AS DOUBLE),0)*100,0)) AS dp FROM (SELECT sku_id, region, date, quantity_on_hand AS q,
  lag(quantity_on_hand) OVER (PARTITION BY sku_id, region ORDER BY date) AS prev FROM inventory_daily WHERE date >= (SELECT d FROM as_of_day)-580)),
h AS (SELECT g.*, coalesce(dp,0) AS dp, round(-abs(a-m7)/(s7+1),6) AS raw FROM g LEFT JOIN d USING (sku_id, region, date)
  WHERE n7>=3 AND l7 IS NOT NULL AND date >= (SELECT d FROM as_of_day)-180),
i AS (SELECT *, count(*) OVER w AS n, least(1,greatest(0,1-(raw-min(raw) OVER w)/(max(raw) OVER w-min(raw) OVER w+1e-9))) AS sc,
  CASE WHEN a>m7 THEN 'spike' ELSE 'drop' END AS dir FROM h WINDOW w AS (PARTITION BY sku_id, region))
SELECT sku_id, region, strftime(date,'%Y-%m-%d') AS date, round(a,1) AS actual_value, round(m7,1) AS expected_value, round(sc,4) AS anomaly_score, dir AS direction,
CASE WHEN is_promotion AND dir='spike' THEN 'Promotion spike' WHEN is_holiday THEN 'Festive demand surge' WHEN dp>30 THEN 'Supply disruption'
 WHEN abs(cp)>15 THEN 'Competitor price event' WHEN dir='drop' AND ws < -0.5e0 THEN 'Adverse weather impact' ELSE 'Unexplained anomaly' END AS probable_cause
FROM i WHERE n>=14 AND sc>=0.7e0""",
}
