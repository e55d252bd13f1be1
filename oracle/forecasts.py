"""Forecast statements."""

_WEIGHT = "exp(-ln(2)/14*rn)"


def seasonal(source: str, keys: str, horizon: int, last: str = "last_date", name: str = "sf") -> str:
    """CTEs ending in ``name``(keys, date, seasonal, lower_bound, upper_bound)."""
    on = f"USING ({keys})"
    return f"""
{name}_a AS (SELECT {keys}, date, CAST(sales_qty AS DOUBLE) AS y, is_holiday AS hol, is_promotion AS promo, isodow(date)-1 AS dow, month(date) AS mon,
  CAST(date - DATE '1970-01-01' AS DOUBLE) AS t FROM {source}),
{name}_l AS (SELECT {keys}, coalesce(regr_slope(y, t),0) AS slope, avg(y) AS ybar, avg(t) AS tbar, max(date) AS last_date FROM {name}_a GROUP BY {keys}),
{name}_b AS (SELECT *, greatest(ybar+slope*(t-tbar), ybar*0.1e0) AS trend FROM {name}_a JOIN {name}_l {on}),
{name}_c AS (SELECT *, y/nullif(trend,0) AS r1 FROM {name}_b),
{name}_d AS (SELECT *, coalesce(avg(r1) OVER (PARTITION BY {keys}, dow),1) AS wk FROM {name}_c),
{name}_e AS (SELECT *, r1/nullif(wk,0) AS r2 FROM {name}_d),
{name}_f AS (SELECT *, coalesce(avg(r2) OVER (PARTITION BY {keys}, mon),1) AS yr FROM {name}_e),
{name}_g AS (SELECT *, r2/nullif(yr,0) AS r3 FROM {name}_f),
{name}_h AS (SELECT *, coalesce(avg(r3) FILTER (WHERE hol) OVER w/nullif(avg(r3) FILTER (WHERE NOT hol) OVER w,0),1) AS he FROM {name}_g WINDOW w AS (PARTITION BY {keys})),
{name}_i AS (SELECT *, CASE WHEN hol THEN r3/nullif(he,0) ELSE r3 END AS r4 FROM {name}_h),
{name}_j AS (SELECT *, coalesce(avg(r4) FILTER (WHERE promo) OVER w/nullif(avg(r4) FILTER (WHERE NOT promo) OVER w,0),1) AS pe FROM {name}_i WINDOW w AS (PARTITION BY {keys})),
{name}_k AS (SELECT *, trend*wk*yr*(CASE WHEN hol THEN he ELSE 1 END)*(CASE WHEN promo THEN pe ELSE 1 END) AS fit FROM {name}_j),
{name}_p AS (SELECT {keys}, max({last}) AS last_date, max(ybar) AS ybar, max(tbar) AS tbar, max(slope) AS slope, max(he) AS he,
  coalesce(stddev_samp(y-fit),0) AS sd FROM {name}_k GROUP BY {keys}),
{name}_w AS (SELECT DISTINCT {keys}, dow, wk FROM {name}_k),
{name}_m AS (SELECT DISTINCT {keys}, mon, yr FROM {name}_k),
{name}_q AS (SELECT *, CAST(last_date + CAST(h AS INT) AS DATE) AS date FROM {name}_p JOIN (SELECT unnest(generate_series(1,{horizon})) AS h) ON true),
{name}_r AS (SELECT q.*, isodow(date)-1 AS dow, month(date) AS mon, greatest(ybar+slope*((date - DATE '1970-01-01')-tbar), ybar*0.1e0) AS trend FROM {name}_q q),
{name} AS (SELECT {keys}, date, v AS seasonal, v-1.645e0*sd AS lower_bound, v+1.645e0*sd AS upper_bound FROM (
  SELECT r.*, trend*coalesce(wk,1)*coalesce(yr,1)*(CASE WHEN month(date)*100+day(date) IN (101,126,815,1002,1225) THEN he ELSE 1 END) AS v
  FROM {name}_r r LEFT JOIN {name}_w USING ({keys}, dow) LEFT JOIN {name}_m USING ({keys}, mon)))"""


def lookback(source: str, keys: str, horizon: int, last: str = "max(date)", name: str = "lf") -> str:
    """CTEs ending in ``name``(keys, date, lookback)."""
    return f"""
{name}_a AS (SELECT {keys}, date, CAST(sales_qty AS DOUBLE) AS y, isodow(date)-1 AS dow, count(*) OVER (PARTITION BY {keys}) AS n,
  row_number() OVER (PARTITION BY {keys} ORDER BY date DESC) AS rn FROM {source}),
{name}_b AS (SELECT *, coalesce(avg(y) OVER (PARTITION BY {keys}, dow)/nullif(avg(y) OVER (PARTITION BY {keys}),0),1) AS wk FROM {name}_a WHERE n>=60),
{name}_c AS (SELECT {keys}, {last} AS last_date, sum({_WEIGHT}*y/nullif(wk,0)) FILTER (WHERE rn<=60 AND wk<>0)/sum({_WEIGHT}) FILTER (WHERE rn<=60 AND wk<>0) AS lev
  FROM {name}_b GROUP BY {keys}),
{name}_w AS (SELECT DISTINCT {keys}, dow, wk FROM {name}_b),
{name}_q AS (SELECT *, CAST(last_date + CAST(h AS INT) AS DATE) AS date, isodow(CAST(last_date + CAST(h AS INT) AS DATE))-1 AS dow FROM {name}_c JOIN (SELECT unnest(generate_series(1,{horizon})) AS h) ON true),
{name} AS (SELECT {keys}, date, greatest(0, coalesce(lev,0)*coalesce(wk,1)) AS lookback FROM {name}_q LEFT JOIN {name}_w USING ({keys}, dow))"""


def naive(horizon: int, name: str = "nf") -> str:
    return f"""
{name} AS (SELECT l.sku_id, l.region, CAST(l.ld + CAST(h AS INT) AS DATE) AS date, CAST(s.sales_qty AS DOUBLE) AS naive
  FROM (SELECT sku_id, region, max(date) AS ld FROM sales GROUP BY 1,2) l JOIN (SELECT unnest(generate_series(1,{horizon})) AS h) ON true
  JOIN sales s ON s.sku_id=l.sku_id AND s.region=l.region AND s.date = l.ld + CAST(h AS INT) - 364*CAST(ceil(h/364e0) AS INT))"""


_K = "sku_id, region"
_FK = "fold, sku_id, region"
_ERR = """count(*) AS rows, round(avg(abs(a-p)/nullif(CAST(a AS DOUBLE),0)*100),{n}) AS mape, round(sqrt(avg((p-a)*(p-a))),{n}) AS rmse,
  round(sum(abs(p-a))/CAST(sum(a) AS DOUBLE)*100,{n}) AS wape, round(avg(p-a),{n}) AS bias"""
_TRAIN = """train AS (SELECT s.*, fold FROM sales s JOIN (SELECT unnest([1,2,3]) AS fold) ON s.date <= (SELECT d FROM as_of_day)-28*fold),
act AS (SELECT sku_id, region, date, sales_qty AS a, CAST(floor(((SELECT d FROM as_of_day)-date)/28e0) AS INT)+1 AS fold FROM sales)"""
_CUT = "(SELECT d FROM as_of_day)-28*fold"
_HOLD = "(SELECT d FROM as_of_day)-90"


def _grid() -> str:
    return ",".join(f"({i/10}e0,{j/10}e0,{(10-i-j)/10}e0)" for i in range(11) for j in range(11 - i))


FORECASTS = {
    "seasonal_strength": """
WITH r AS (SELECT sku_id, region, CAST(sales_qty AS DOUBLE) AS y, isodow(date)-1 AS dow, month(date) AS mon, row_number() OVER (PARTITION BY sku_id, region ORDER BY date)-1 AS i FROM sales),
a AS (SELECT sku_id, region, stddev_samp(m) AS v FROM (SELECT sku_id, region, dow, avg(y) AS m FROM r GROUP BY 1,2,3) GROUP BY 1,2),
b AS (SELECT sku_id, region, stddev_samp(m) AS v FROM (SELECT sku_id, region, mon, avg(y) AS m FROM r GROUP BY 1,2,3) GROUP BY 1,2),
c AS (SELECT sku_id, region, regr_slope(y,i) AS v FROM r GROUP BY 1,2)
SELECT sku_id, region, round(a.v,6) AS weekly_amplitude, round(b.v,6) AS monthly_amplitude, round(c.v,6)+0e0 AS trend_slope_per_day
FROM a JOIN b USING (sku_id, region) JOIN c USING (sku_id, region)""",
    "seasonal_forecast": "WITH " + seasonal("sales", _K, 28) + """
SELECT sku_id, region, date, round(seasonal,6) AS seasonal, round(lower_bound,6) AS lower_bound, round(upper_bound,6) AS upper_bound FROM sf""",
    "lookback_forecast": "WITH " + lookback("sales", _K, 28) + " SELECT sku_id, region, date, round(lookback,6) AS lookback FROM lf",
    "seasonal_naive": "WITH " + naive(365) + " SELECT * FROM nf",
    "ensemble_forecast": "WITH " + seasonal("sales", _K, 28) + "," + lookback("sales", _K, 28) + "," + naive(28) + """
SELECT sf.sku_id, sf.region, sf.date, round((coalesce(0.4e0*seasonal,0)+coalesce(0.4e0*naive,0)+coalesce(0.2e0*lookback,0))/
  nullif((CASE WHEN seasonal IS NULL THEN 0 ELSE 0.4e0 END)+(CASE WHEN naive IS NULL THEN 0 ELSE 0.4e0 END)+(CASE WHEN lookback IS NULL THEN 0 ELSE 0.2e0 END),0),1) AS predicted_demand,
  round(lower_bound,1) AS lower_bound, round(upper_bound,1) AS upper_bound, 'ensemble' AS model_used
FROM sf LEFT JOIN lf USING (sku_id, region, date) LEFT JOIN nf USING (sku_id, region, date)""",
    "backtest_naive": f"""
WITH x AS (SELECT s.sales_qty AS a, y.sales_qty AS p, CAST(floor(((SELECT d FROM as_of_day)-s.date)/28e0) AS INT)+1 AS fold
  FROM sales s JOIN sales y ON y.sku_id=s.sku_id AND y.region=s.region AND y.date=s.date-364)
SELECT fold, {_ERR.format(n=6)} FROM x WHERE fold<=6 GROUP BY 1""",
    "backtest_seasonal": "WITH " + _TRAIN + "," + seasonal("train", _FK, 28, last=_CUT) + f"""
SELECT fold, {_ERR.format(n=4)} FROM (SELECT fold, a, seasonal AS p FROM act JOIN sf USING (fold, sku_id, region, date)) GROUP BY 1""",
    "backtest_lookback": "WITH " + _TRAIN + "," + lookback("train", _FK, 28, last="max(" + _CUT + ")") + f"""
SELECT fold, {_ERR.format(n=4)} FROM (SELECT fold, a, lookback AS p FROM act JOIN lf USING (fold, sku_id, region, date)) GROUP BY 1""",
    "tune_weights": f"WITH train AS (SELECT * FROM sales WHERE date <= {_HOLD})," + seasonal("train", _K, 90, last=_HOLD) + ","
    + lookback("train", _K, 90, last=f"max({_HOLD})") + f""",
x AS (SELECT category, s.sales_qty AS a, seasonal, CAST(y.sales_qty AS DOUBLE) AS naive, lookback FROM sales s
  JOIN sales y ON y.sku_id=s.sku_id AND y.region=s.region AND y.date=s.date-364 JOIN products p ON p.sku_id=s.sku_id
  JOIN sf ON sf.sku_id=s.sku_id AND sf.region=s.region AND sf.date=s.date JOIN lf ON lf.sku_id=s.sku_id AND lf.region=s.region AND lf.date=s.date
  WHERE s.date > {_HOLD}),
g AS (SELECT * FROM (VALUES {_grid()}) t(w_seasonal, w_naive, w_lookback)),
e AS (SELECT category, w_seasonal, w_naive, w_lookback, round(sum(abs(a-(seasonal*w_seasonal+naive*w_naive+lookback*w_lookback)))/CAST(sum(a) AS DOUBLE)*100,6) AS wape
  FROM x JOIN g ON true GROUP BY 1,2,3,4)
SELECT category, round(wape,4) AS wape, w_seasonal, w_naive, w_lookback FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY wape, w_seasonal, w_naive, w_lookback) AS rn FROM e) WHERE rn=1""",
    "conformal_widths": f"WITH train AS (SELECT * FROM sales WHERE date <= {_HOLD})," + seasonal("train", _K, 90, last=_HOLD) + ","
    + lookback("train", _K, 90, last=f"max({_HOLD})") + f""",
lv AS (SELECT sku_id, region, greatest(avg(sales_qty),1) AS level FROM train GROUP BY 1,2),
h AS (SELECT sku_id, region, date, sales_qty, CAST(floor((date-({_HOLD})-1)/7e0) AS INT) AS week, level, seasonal, lookback FROM sales
  JOIN lv USING (sku_id, region) LEFT JOIN sf USING (sku_id, region, date) LEFT JOIN lf USING (sku_id, region, date) WHERE date > {_HOLD}),
u AS (SELECT 'seasonal' AS member, week, abs(sales_qty-seasonal)/level AS score FROM h UNION ALL SELECT 'lookback', week, abs(sales_qty-lookback)/level FROM h),
r AS (SELECT *, row_number() OVER (PARTITION BY member, week ORDER BY score) AS k, count(*) OVER (PARTITION BY member, week) AS n FROM u WHERE score IS NOT NULL)
SELECT member, week, n, round(score,6) AS width FROM r WHERE k = CAST(ceil((n+1)*900000/1e6) AS BIGINT)""",
    "backtest_members": "WITH " + _TRAIN + "," + seasonal("train", _FK, 28, last=_CUT) + "," + lookback("train", _FK, 28, last="max(" + _CUT + ")") + f""",
m AS (SELECT fold, a, seasonal, lookback FROM act JOIN sf USING (fold, sku_id, region, date) LEFT JOIN lf USING (fold, sku_id, region, date)),
e AS (SELECT fold, 'seasonal' AS member, a, seasonal AS p FROM m UNION ALL SELECT fold, 'lookback', a, lookback FROM m WHERE lookback IS NOT NULL
  UNION ALL SELECT fold, 'ensemble', a, CASE WHEN lookback IS NULL THEN seasonal ELSE (0.4e0*seasonal+0.2e0*lookback)/(0.4e0+0.2e0) END FROM m)
SELECT fold, member, {_ERR.format(n=4)} FROM e GROUP BY 1,2""",
    "trained_model_errors": """
WITH hist AS (SELECT * FROM sales WHERE date >= (SELECT d FROM as_of_day)-548),
train AS (SELECT *, 1 AS fold FROM hist WHERE date <= (SELECT d FROM as_of_day)-28),
act AS (SELECT sku_id, region, date, sales_qty AS a, 1 AS fold FROM hist WHERE date > (SELECT d FROM as_of_day)-28),""" + seasonal("train", _FK, 28, last=_CUT) + ","
    + lookback("train", _FK, 28, last="max(" + _CUT + ")") + """,
e AS (SELECT 'seasonal' AS model_name, a, seasonal AS p FROM act JOIN sf USING (fold, sku_id, region, date)
  UNION ALL SELECT 'lookback', a, lookback FROM act JOIN lf USING (fold, sku_id, region, date)
  UNION ALL SELECT 'naive', act.a, y.sales_qty FROM act JOIN hist y ON y.sku_id=act.sku_id AND y.region=act.region AND y.date=act.date-364)
SELECT model_name, count(*) AS rows, round(avg(abs(a-p)/nullif(CAST(a AS DOUBLE),0)*100),4) AS avg_mape, round(sqrt(avg((p-a)*(p-a))),4) AS avg_rmse FROM e GROUP BY 1""",
    "served_forecast": "WITH past AS (SELECT * FROM sales WHERE date <= (SELECT d FROM as_of_day)-28)," + seasonal("past", _K, 28) + "," + lookback("past", _K, 28) + """
SELECT sku_id, region, date, round(CASE WHEN lookback IS NULL THEN seasonal ELSE (0.4e0*seasonal+0.2e0*lookback)/(0.4e0+0.2e0) END,1) AS predicted_demand,
  'ensemble' AS model_used, 1 AS model_version FROM sf LEFT JOIN lf USING (sku_id, region, date)""",
}
