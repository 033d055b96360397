"""DuckDB restatement of the calendar ridge, the choice among models and the chosen forecast.

The ridge is solved here from its dense normal equations (a column per site) by Gauss-Jordan steps
in a recursive query, one system per origin; the 28 days follow in a second recursive query. The
library eliminates site blocks and folds arrays instead, so the two share no step.
"""

from __future__ import annotations

from ..operators import forecast
from ..sources.adapters import HISTORY_END, HISTORY_START
from .oracle_base import cte

_ORIGINS = [*forecast.folds(HISTORY_END), ("Future", 0, 0)]

cte(
    "ridge_origins",
    [],
    "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{p}', {k}, CAST(DATE '{HISTORY_END}' - {back} AS DATE))" for i, (p, k, back) in enumerate(_ORIGINS))
    + ") o(k, evaluation_period, fold, origin_date)",
)

_CALENDAR = f"""isodow(business_date) - 1 AS d, CASE WHEN isodow(business_date) >= 6 THEN 1.0 ELSE 0.0 END AS wk,
         sin(2 * pi() * dayofyear(business_date) / 365.25) AS s1, cos(2 * pi() * dayofyear(business_date) / 365.25) AS c1,
         (business_date - DATE '{HISTORY_START}') / 365.25 AS yr,
         CASE WHEN (month(business_date) = 1 AND day(business_date) = 1) OR (month(business_date) = 12 AND day(business_date) = 25) THEN 1.0 ELSE 0.0 END AS ho"""

cte(
    "ridge_paths",
    ["store_day_ledger", "restaurants", "ridge_origins"],
    f"""WITH RECURSIVE h AS (
  SELECT restaurant_id, business_date, revenue, lag(revenue, 7) OVER w AS lag7, lag(revenue, 28) OVER w AS lag28,
         CASE WHEN count(revenue) OVER w28 = 28 THEN avg(revenue) OVER w28 END AS mean28, {_CALENDAR}
  FROM store_day_ledger
  WINDOW w AS (PARTITION BY restaurant_id ORDER BY business_date),
         w28 AS (PARTITION BY restaurant_id ORDER BY business_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)),
x AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM h WHERE lag7 IS NOT NULL AND lag28 IS NOT NULL AND mean28 IS NOT NULL),
e AS MATERIALIZED (
  SELECT r, unnest(['s' || restaurant_id, 'd' || d, 'w' || restaurant_id, 'sin', 'cos', 'yr', 'ho', 'lag7', 'lag28', 'mean28']) AS f,
         unnest([1.0::DOUBLE, 1.0, wk, s1, c1, yr, ho, lag7, lag28, mean28]) AS v FROM x),
xo AS MATERIALIZED (SELECT k, r, revenue AS y FROM x JOIN ridge_origins ON business_date <= origin_date),
t AS MATERIALIZED (SELECT k, count(*)::DOUBLE AS n, avg(y) AS my FROM xo GROUP BY k),
names AS (SELECT f, row_number() OVER (ORDER BY f) AS j FROM (SELECT DISTINCT f FROM e)),
u AS (SELECT k, f, sum(v) AS v1, sum(v * v) AS v2, sum(v * y) AS vy FROM xo JOIN e USING (r) GROUP BY k, f),
f AS MATERIALIZED (
  SELECT t.k, names.f, j, n, my, coalesce(v1, 0) / n AS m, coalesce(v2, 0) / n - pow(coalesce(v1, 0) / n, 2) AS var, coalesce(vy, 0) AS vy
  FROM t CROSS JOIN names LEFT JOIN u ON u.k = t.k AND u.f = names.f),
a AS MATERIALIZED (SELECT k, p.f AS p, q.f AS q, sum(p.v * q.v) AS v FROM xo JOIN e p USING (r) JOIN e q USING (r) GROUP BY k, p.f, q.f),
left_ AS (
  SELECT p.k, p.j, list(coalesce(a.v, 0) - p.n * p.m * q.m + CASE WHEN p.j = q.j THEN 60 * CASE WHEN p.var > 1e-15 THEN p.var ELSE 1 END ELSE 0 END ORDER BY q.j) AS w
  FROM f p JOIN f q ON p.k = q.k LEFT JOIN a ON a.k = p.k AND a.p = p.f AND a.q = q.f GROUP BY p.k, p.j),
g(i, k, m) AS (
  SELECT 0, f.k, list(list_append(w, vy - n * f.m * my) ORDER BY f.j) FROM left_ JOIN f ON f.k = left_.k AND f.j = left_.j GROUP BY f.k
  UNION ALL
  SELECT i + 1, k, list_transform(m, lambda w, c: CASE WHEN c = i + 1 THEN list_transform(w, lambda z: z / w[i + 1])
           ELSE list_transform(list_zip(w, m[i + 1]), lambda z: z[1] - w[i + 1] / m[i + 1][i + 1] * z[2]) END)
  FROM g WHERE i < len(m)),
beta AS MATERIALIZED (SELECT f.k, f.f, g.m[f.j][-1] AS b, f.m AS fm, f.my FROM f JOIN g ON g.k = f.k AND g.i = len(g.m)),
c AS (SELECT k, any_value(my) - sum(b * fm) AS c0 FROM beta GROUP BY k),
fut AS (
  SELECT *, {_CALENDAR} FROM (
    SELECT k, restaurant_id, h, CAST(origin_date + h AS DATE) AS business_date
    FROM ridge_origins, restaurants, (SELECT CAST(range AS INTEGER) AS h FROM range(1, 29)))),
fe AS (
  SELECT k, restaurant_id, h, unnest(['s' || restaurant_id, 'd' || d, 'w' || restaurant_id, 'sin', 'cos', 'yr', 'ho']) AS f,
         unnest([1.0::DOUBLE, 1.0, wk, s1, c1, yr, ho]) AS v FROM fut),
base AS MATERIALIZED (SELECT k, restaurant_id, h, any_value(c0) + sum(v * b) AS b0 FROM fe JOIN beta USING (k, f) JOIN c USING (k) GROUP BY k, restaurant_id, h),
lags AS (SELECT k, max(CASE f WHEN 'lag7' THEN b END) AS b7, max(CASE f WHEN 'lag28' THEN b END) AS b28, max(CASE f WHEN 'mean28' THEN b END) AS bm FROM beta GROUP BY k),
walk(k, restaurant_id, h, s) AS (
  SELECT k, restaurant_id, 0, list(revenue::DOUBLE ORDER BY business_date) FROM store_day_ledger JOIN ridge_origins
    ON business_date <= origin_date AND business_date > origin_date - 28 GROUP BY k, restaurant_id
  UNION ALL
  SELECT w.k, w.restaurant_id, w.h + 1, list_append(s, greatest(b0 + b7 * s[len(s) - 6] + b28 * s[len(s) - 27] + bm * list_avg(s[len(s) - 27:len(s)]), 0.0))
  FROM walk w JOIN base ON base.k = w.k AND base.restaurant_id = w.restaurant_id AND base.h = w.h + 1 JOIN lags ON lags.k = w.k)
SELECT w.restaurant_id, CAST(o.origin_date + t.h AS DATE) AS business_date, t.h AS horizon_day, round(w.s[28 + t.h] * 100) / 100 AS forecast_revenue,
       'Calendar ridge' AS model, o.origin_date, o.evaluation_period, o.fold
FROM walk w JOIN ridge_origins o USING (k), (SELECT CAST(range AS INTEGER) AS h FROM range(1, 29)) t WHERE w.h = 28""",
)
cte(
    "ridge_traces",
    ["ridge_paths", "store_day_ledger"],
    "SELECT p.*, s.revenue AS actual_revenue FROM ridge_paths p JOIN store_day_ledger s USING (restaurant_id, business_date) WHERE p.evaluation_period <> 'Future'",
)
cte(
    "model_traces",
    ["traces", "ridge_traces"],
    "SELECT restaurant_id, business_date, horizon_day, forecast_revenue, model, origin_date, evaluation_period, fold, actual_revenue FROM traces "
    "UNION ALL SELECT restaurant_id, business_date, horizon_day, forecast_revenue, model, origin_date, evaluation_period, fold, actual_revenue FROM ridge_traces",
)
cte(
    "winner",
    ["model_traces"],
    """SELECT arg_min(model, (mae, model)) AS winner FROM (
  SELECT model, avg(mae) AS mae FROM (
    SELECT model, fold, avg(abs(actual_revenue - forecast_revenue)) AS mae FROM model_traces WHERE evaluation_period = 'Validation' GROUP BY model, fold)
  GROUP BY model)""",
)
cte(
    "forecast_daily",
    ["model_traces", "ridge_paths", "restaurants", "store_day_ledger", "winner"],
    f"""WITH b AS (SELECT restaurant_id, quantile_cont(abs(actual_revenue - forecast_revenue), 0.8) AS band
           FROM model_traces WHERE evaluation_period = 'Validation' AND model = (SELECT winner FROM winner) GROUP BY restaurant_id),
n AS (SELECT r.restaurant_id, CAST(DATE '{HISTORY_END}' + h AS DATE) AS business_date,
             CASE WHEN s.revenue IS NOT NULL THEN greatest(s.revenue, 0.0) END AS forecast_revenue
      FROM restaurants r, (SELECT CAST(range AS INTEGER) AS h FROM range(1, 29)) t
      LEFT JOIN store_day_ledger s ON s.restaurant_id = r.restaurant_id
           AND s.business_date = CAST(DATE '{HISTORY_END}' - 6 + ((h - 1) % 7) AS DATE)),
f AS (SELECT restaurant_id, business_date, forecast_revenue, 'Seasonal naive' AS model FROM n
      UNION ALL SELECT restaurant_id, business_date, forecast_revenue, model FROM ridge_paths WHERE evaluation_period = 'Future')
SELECT f.restaurant_id, f.business_date, DATE '{HISTORY_END}' AS origin_date, f.forecast_revenue,
       CASE WHEN f.forecast_revenue - b.band IS NOT NULL THEN greatest(f.forecast_revenue - b.band, 0.0) END AS lower_80,
       f.forecast_revenue + b.band AS upper_80, f.model
FROM f LEFT JOIN b USING (restaurant_id) WHERE f.model = (SELECT winner FROM winner)""",
)
