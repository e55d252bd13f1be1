"""Monitoring, quality, promotion and search statements."""

_PSI_BINS = range(10)


def _psi() -> str:
    cuts = ",".join(f"{i / 10}e0" for i in range(1, 10))
    ref = ",".join(f"greatest(count(*) FILTER (WHERE NOT cur AND bin={i})/CAST(nr AS DOUBLE),1e-4) AS r{i}, "
                   f"greatest(count(*) FILTER (WHERE cur AND bin={i})/CAST(nc AS DOUBLE),1e-4) AS c{i}" for i in _PSI_BINS)
    total = "+".join(f"(c{i}-r{i})*ln(c{i}/r{i})" for i in _PSI_BINS)
    return f"""
WITH x AS (SELECT sku_id, CAST(sales_qty AS DOUBLE) AS x, date > (SELECT d FROM as_of_day)-7 AS cur FROM sales
  WHERE date > (SELECT d FROM as_of_day)-37),
e AS (SELECT sku_id, quantile_cont(x, [{cuts}]) AS edges FROM x WHERE NOT cur GROUP BY 1),
b AS (SELECT x.*, len(list_filter(edges, lambda q: q < x.x)) AS bin,
  count(*) FILTER (WHERE NOT cur) OVER (PARTITION BY sku_id) AS nr, count(*) FILTER (WHERE cur) OVER (PARTITION BY sku_id) AS nc
  FROM x JOIN e USING (sku_id)),
s AS (SELECT sku_id, nr AS n_ref, nc AS n_cur, {ref} FROM b WHERE nr>0 AND nc>0 GROUP BY sku_id, nr, nc)
SELECT sku_id, n_ref, n_cur, round({total},6) AS psi, {total} > 0.2 AS drifted FROM s"""


_REALIZED = """
WITH r AS (SELECT f.sku_id, f.region, f.forecast_date, f.target_date, f.predicted_qty, f.model_name, f.model_version,
  CASE WHEN f.realized_mape IS NULL AND s.sku_id IS NOT NULL AND f.target_date=(SELECT d FROM as_of_day)-1
    THEN abs(s.sales_qty-f.predicted_qty)/nullif(CAST(s.sales_qty AS DOUBLE),0)*100 ELSE f.realized_mape END AS realized_mape
  FROM forecasts f LEFT JOIN sales s ON s.sku_id=f.sku_id AND s.region=f.region AND s.date=f.target_date)"""


def _expanded(before: int, after: int, name: str = "ex") -> str:
    return f"""{name} AS (SELECT promo_id, discount_pct, start_date, end_date, s.sku_id, s.region, s.date, s.sales_qty, s.revenue_inr,
  CASE WHEN s.date<start_date THEN 'before' WHEN s.date>end_date THEN 'after' ELSE 'during' END AS phase
  FROM promos p JOIN sales s ON s.date BETWEEN p.start_date-{before} AND p.end_date+{after}
  AND (applicable_skus IS NULL OR list_contains(applicable_skus, s.sku_id))
  AND (applicable_regions IS NULL OR list_contains(applicable_regions, s.region)))"""


_DAYS = "DATE '2000-03-01'", "DATE '2000-04-30'"


def _did(treated: str, where: str = "true") -> str:
    return f"""
WITH w AS (SELECT *, date >= {_DAYS[0]} AS post, {treated} AS tr FROM sales
  WHERE {where} AND date BETWEEN {_DAYS[0]}-61 AND {_DAYS[1]}),
m AS (SELECT avg(sales_qty) FILTER (WHERE tr AND NOT post) AS t_pre, avg(sales_qty) FILTER (WHERE tr AND post) AS t_post,
  avg(sales_qty) FILTER (WHERE NOT tr AND NOT post) AS c_pre, avg(sales_qty) FILTER (WHERE NOT tr AND post) AS c_post,
  count(*) FILTER (WHERE tr AND post) AS treated_rows,
  sum(revenue_inr) FILTER (WHERE tr AND post)/sum(sales_qty) FILTER (WHERE tr AND post) AS ur FROM w),
r AS (SELECT *, (t_post-t_pre)-(c_post-c_pre) AS did, t_pre+c_post-c_pre AS ex FROM m)"""


_SKUS = "sku_id IN ('Brand#1','Brand#2','Brand#6')"
_TRI = """list_distinct(flatten(list_transform(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+'),
  lambda w: list_transform(generate_series(1, len(w)+1), lambda i: substr('  '||w||' ', i, 3)))))"""


def _similarity(text: str) -> str:
    a, b = _TRI.format("product_name"), _TRI.format("'" + text + "'")
    return f"""
WITH t AS (SELECT sku_id, product_name, {a} AS a, {b} AS b FROM part_products),
u AS (SELECT sku_id, product_name, round(coalesce(len(list_intersect(a,b))/CAST(nullif(len(list_distinct(list_concat(a,b))),0) AS DOUBLE),0),6) AS similarity FROM t)
SELECT * FROM u"""


MONITORING = {
    "psi_drift": _psi(),
    "realized_mape": _REALIZED + " SELECT round(coalesce(avg(realized_mape),0),6) AS realized_mape FROM r WHERE target_date=(SELECT d FROM as_of_day)-1",
    "realize_forecasts": _REALIZED + " SELECT * REPLACE (round(realized_mape,6) AS realized_mape) FROM r",
    "quality_gate": """
WITH n AS (SELECT model_name, max_by(avg_mape, version) AS m FROM model_versions WHERE stage='Staging' GROUP BY 1)
SELECT count(m) AS models_checked, max(m) AS worst_mape, coalesce(bool_and(m<=25),true) AS passed,
  CASE WHEN coalesce(bool_and(m<=25),true) THEN 'promote_models' ELSE 'alert_quality_failure' END AS next_step FROM n""",
    "latest_model_versions": """
WITH n AS (SELECT *, max(CASE WHEN stage='Staging' THEN version END) OVER (PARTITION BY model_name) AS nv FROM model_versions)
SELECT model_name, version, avg_mape, avg_rmse, CASE WHEN version=nv THEN 'Production' WHEN stage='Production' AND nv IS NOT NULL THEN 'Archived' ELSE stage END AS stage FROM n""",
    "model_forecast_errors": """
SELECT model_name, model_version, count(*) AS rows, round(avg(abs(sales_qty-predicted_qty)/nullif(CAST(sales_qty AS DOUBLE),0)*100),6) AS mape,
  round(sqrt(avg((predicted_qty-sales_qty)*(predicted_qty-sales_qty))),6) AS rmse,
  round(sum(abs(predicted_qty-sales_qty))/sum(sales_qty)*100,6) AS wape, round(avg(predicted_qty-sales_qty),6) AS bias
FROM forecasts f JOIN sales s ON f.sku_id=s.sku_id AND f.region=s.region AND f.target_date=s.date GROUP BY 1,2""",
    "dedupe_latest": """
SELECT * EXCLUDE (rn) REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM (
SELECT * REPLACE (l_tax+0e0 AS l_tax), row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
  l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn=1""",
    "weather_append_absent": """
SELECT region, date, round(CASE WHEN date<=(SELECT d FROM as_of_day)-365 THEN score ELSE score+100 END,6) AS score FROM weather""",
    "weather_scores": """
SELECT region, date, round((score*10+290-295)/10,2)+0e0 AS score, map_extract_value(map(
  ['AFRICA','AMERICA','ASIA','EUROPE','MIDDLE EAST'], ['Chandigarh','Mumbai','Bengaluru','Delhi','Chennai']), region) AS city FROM weather""",
    "dq_unique": "SELECT sku_id, date, count(*) AS copies FROM competitor GROUP BY 1,2 HAVING count(*)>1",
    "dq_not_null": """
SELECT unnest(['sku_id','region','target_date','predicted_qty','realized_mape']) AS column_name,
  unnest([count(*)-count(sku_id),count(*)-count(region),count(*)-count(target_date),count(*)-count(predicted_qty),count(*)-count(realized_mape)]) AS nulls FROM forecasts""",
    "dq_referential": """
SELECT sku_id, count(*) AS orphan_rows, CAST(sum(sales_qty) AS BIGINT) AS orphan_qty FROM sales
WHERE sku_id NOT IN (SELECT sku_id FROM products WHERE is_active) GROUP BY 1""",
    "dq_domain": "SELECT sku_id, region, date, sales_qty FROM sales WHERE NOT (sales_qty BETWEEN 1 AND 60 AND length(region)<=10)",
    "dq_report": """
SELECT 'sales key' AS check_name, (SELECT count(*) FROM (SELECT 1 FROM sales GROUP BY sku_id, region, date HAVING count(*)>1)) AS failures
UNION ALL SELECT 'competitor key', (SELECT count(*) FROM (SELECT 1 FROM competitor GROUP BY sku_id, date HAVING count(*)>1))
UNION ALL SELECT 'inventory key', (SELECT count(*) FROM (SELECT 1 FROM inventory GROUP BY sku_id, warehouse_id, snapshot_date HAVING count(*)>1))
UNION ALL SELECT 'sales product', (SELECT count(*) FROM sales WHERE sku_id NOT IN (SELECT sku_id FROM products))
UNION ALL SELECT 'stock not negative', (SELECT count(*) FROM inventory WHERE quantity_on_hand<0)""",
    "kaplan_meier": """
WITH o AS (SELECT *, CASE WHEN quantity_on_hand=0 THEN 1 ELSE 0 END AS o FROM inventory_daily),
r AS (SELECT *, coalesce(sum(o) OVER (PARTITION BY sku_id, region ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS run FROM o),
sp AS (SELECT sku_id, region, run, CAST(sum(1-o) AS BIGINT) AS duration, max(o) AS ev FROM r GROUP BY 1,2,3 HAVING sum(1-o)>0),
st AS (SELECT region, duration, CAST(sum(ev) AS BIGINT) AS events, count(*) AS ended FROM sp GROUP BY 1,2),
n AS (SELECT *, CAST(sum(ended) OVER (PARTITION BY region ORDER BY duration DESC) AS BIGINT) AS at_risk FROM st)
SELECT region, duration, at_risk, events, round(CASE WHEN max(CASE WHEN events>=at_risk THEN 1 ELSE 0 END) OVER w = 1 THEN 0 ELSE
  exp(sum(CASE WHEN events<at_risk THEN ln(1-events/CAST(at_risk AS DOUBLE)) END) OVER w) END,6) AS survival FROM n
WINDOW w AS (PARTITION BY region ORDER BY duration)""",
    "promo_expand": "WITH " + _expanded(7, 7) + " SELECT promo_id, phase, sku_id, region, date, sales_qty, CAST(discount_pct AS DOUBLE) AS discount_pct FROM ex",
    "promo_tagged_sales": "WITH " + _expanded(0, 0) + """, b AS (SELECT sku_id, region, date, promo_id, row_number() OVER (PARTITION BY sku_id, region, date ORDER BY discount_pct DESC, promo_id DESC) AS rn FROM ex)
SELECT s.sku_id, s.region, s.date, s.sales_qty, b.promo_id, b.promo_id IS NOT NULL AS is_promotion FROM sales s LEFT JOIN b ON b.sku_id=s.sku_id AND b.region=s.region AND b.date=s.date AND rn=1""",
    "promo_lift": "WITH " + _expanded(28, 0) + """, m AS (SELECT sku_id, promo_id, avg(sales_qty) FILTER (WHERE phase='during') AS a, avg(sales_qty) FILTER (WHERE phase='before') AS b FROM ex GROUP BY 1,2)
SELECT sku_id, promo_id, round(a,6) AS avg_during, round(b,6) AS avg_before, round(a/nullif(b,0),6) AS lift_ratio, round((a-b)/nullif(b,0)*100,6) AS uplift_pct FROM m""",
    "promo_decay": "WITH " + _expanded(28, 14) + """, b AS (SELECT promo_id, avg(sales_qty) AS base FROM ex WHERE phase='before' GROUP BY 1),
a AS (SELECT promo_id, CAST(date-end_date AS INT) AS day, avg(sales_qty) AS av FROM ex WHERE phase='after' GROUP BY 1,2)
SELECT promo_id, day, round(av,6) AS avg_sales, round(base,6) AS baseline, round(av/nullif(base,0),6) AS relative_demand FROM a JOIN b USING (promo_id)""",
    "uplift_pct": """
WITH m AS (SELECT sku_id, avg(sales_qty) FILTER (WHERE is_promotion) AS d, avg(sales_qty) FILTER (WHERE NOT is_promotion) AS b FROM sales GROUP BY 1)
SELECT sku_id, round(d,6) AS during, round(b,6) AS baseline, round((d-b)/nullif(b,0)*100,6) AS uplift_pct,
  CASE WHEN d/nullif(b,0)>3 THEN 'high' WHEN d/nullif(b,0)>2 THEN 'medium' ELSE 'low' END AS band FROM m""",
    "did_lift": _did(_SKUS) + """
SELECT 'discount' AS promotion_type, round(t_pre,4) AS t_pre, round(t_post,4) AS t_post, round(c_pre,4) AS c_pre, round(c_post,4) AS c_post, treated_rows,
  round(did,4) AS did, round(t_post/nullif(ex,0),4) AS lift_multiplier, round(did*treated_rows*ur,4) AS incremental_revenue_inr FROM r""",
    "price_elasticity": _did(_SKUS, "region IN ('ASIA','EUROPE')") + """
SELECT 'bogo' AS promotion_type, round(did,6) AS did, round(did/ex*100/-20,6) AS price_elasticity FROM r""",
    "cannibalization": f"""
WITH w AS (SELECT category, {_SKUS} AS tr, CASE WHEN date>={_DAYS[0]} THEN sales_qty ELSE -sales_qty END AS q FROM sales JOIN products USING (sku_id)
  WHERE date BETWEEN {_DAYS[0]}-61 AND {_DAYS[1]}),
c AS (SELECT category, CAST(coalesce(sum(q) FILTER (WHERE tr),0) AS BIGINT) AS g, CAST(coalesce(sum(q) FILTER (WHERE NOT tr),0) AS BIGINT) AS o, count(*) FILTER (WHERE tr) AS n FROM w GROUP BY 1)
SELECT category, g AS promoted_gain, o AS others_change, CASE WHEN g>0 THEN round(greatest(0,-o)/CAST(g AS DOUBLE),6) END AS cannibalization_rate FROM c WHERE n>0""",
    "fuzzy_product_search": _similarity("blu widgets") + " WHERE similarity>0 ORDER BY similarity DESC, product_name, sku_id LIMIT 50",
    "product_similarity": _similarity("smal rings"),
    "similar_product_names": f"""
WITH n AS MATERIALIZED (SELECT product_name, min(sku_id) AS sku_id, any_value({_TRI.format("product_name")}) AS g FROM part_products GROUP BY 1),
p AS (SELECT a.sku_id AS sku_a, b.sku_id AS sku_b, len(list_intersect(a.g,b.g)) AS s, len(a.g)+len(b.g) AS t FROM n a JOIN n b ON a.sku_id<b.sku_id)
SELECT sku_a, sku_b, round(s/CAST(t-s AS DOUBLE),6) AS similarity FROM p WHERE s > 0 AND s/CAST(t-s AS DOUBLE) >= 0.6-1e-9""",
}
