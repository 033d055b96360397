"""Forecast feature matrix, calendar-ridge backtest and model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast, forecast_models
from ..sources.adapters import HISTORY_START
from .oracle_base import cte, typed, with_ctes
from .q_analysis import RATE_SQL, SUMS_SQL, TRACE_SPEC
from .registry import query

FEATURE_SQL = f"""WITH h AS (
  SELECT restaurant_id, business_date, revenue, is_public_holiday AS holiday,
         lag(revenue, 7) OVER w AS lag7, lag(revenue, 28) OVER w AS lag28,
         CASE WHEN count(revenue) OVER w28 = 28 THEN avg(revenue) OVER w28 END AS mean28
  FROM store_day_ledger
  WINDOW w AS (PARTITION BY restaurant_id ORDER BY business_date),
         w28 AS (PARTITION BY restaurant_id ORDER BY business_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
SELECT restaurant_id, business_date, revenue, lag7, lag28, mean28, holiday,
       isodow(business_date) - 1 AS weekday, CASE WHEN isodow(business_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       sin(2 * pi() * dayofyear(business_date) / 365.25) AS annual_sin,
       cos(2 * pi() * dayofyear(business_date) / 365.25) AS annual_cos,
       (business_date - DATE '{HISTORY_START}') / 365.25 AS trend_years
FROM h WHERE lag7 IS NOT NULL AND lag28 IS NOT NULL AND mean28 IS NOT NULL"""


@query(
    "f01_feature_matrix",
    typed(
        with_ctes(["store_day_ledger"], FEATURE_SQL),
        "restaurant_id:i, business_date:t, revenue:d, lag7:d, lag28:d, mean28:d, holiday:i, weekday:i, "
        "is_weekend:i, annual_sin:d, annual_cos:d, trend_years:d",
    ),
)
def f01_feature_matrix(ctx):
    """Pre-encoding features: calendar terms, holiday, lag7, lag28, prior-28 mean."""
    hist = ctx.store_day.select("restaurant_id", "business_date", "revenue")
    return forecast_models.feature_rows(hist, ctx.restaurants, ctx.calendar, HISTORY_START).select(
        "restaurant_id", "business_date", "revenue", "lag7", "lag28", "mean28", "holiday", "weekday",
        "is_weekend", "annual_sin", "annual_cos", "trend_years",
    )


@query("f03_ridge_backtest", typed(with_ctes(["ridge_traces"], "SELECT * FROM ridge_traces"), TRACE_SPEC))
def f03_ridge_backtest(ctx):
    """Calendar ridge (alpha 60, standardised) recursive 28-day traces per fold and holdout."""
    return ctx.ridge_traces.select(
        "restaurant_id", "business_date", "horizon_day", "forecast_revenue", "model", "origin_date",
        "evaluation_period", "fold", "actual_revenue",
    )


_METRICS = """SELECT evaluation_period, fold, model,
       avg(abs(actual_revenue - forecast_revenue)) AS mae,
       sqrt(avg((actual_revenue - forecast_revenue) * (actual_revenue - forecast_revenue))) AS rmse,
       avg(CASE WHEN actual_revenue > 0 THEN abs(actual_revenue - forecast_revenue) / actual_revenue END) * 100 AS mape,
       sum(abs(actual_revenue - forecast_revenue)) / nullif(sum(actual_revenue), 0) * 100 AS wape,
       count(*) AS observations, model = (SELECT winner FROM winner) AS is_winner
FROM model_traces GROUP BY evaluation_period, fold, model"""


@query(
    "f08_model_comparison",
    typed(
        with_ctes(["model_traces", "winner"], _METRICS),
        "evaluation_period:s, fold:i, model:s, mae:d, rmse:d, mape:d, wape:d, observations:i, is_winner:b",
    ),
)
def f08_model_comparison(ctx):
    """Per period / fold / model metrics of seasonal naive and ridge, with the
    validation-MAE winner flagged (F06, F08)."""
    return _comparison(ctx)


def _comparison(ctx, boosted: bool = False):
    m = forecast.metrics(ctx.model_traces(boosted), ["evaluation_period", "fold", "model"])
    winner = forecast.select_winner(m)
    return m.crossJoin(F.broadcast(winner)).withColumn("is_winner", F.col("model") == F.col("winner")).drop("winner")


@query("f08_model_selection", typed(with_ctes(["winner"], "SELECT winner FROM winner"), "winner:s"))
def f08_model_selection(ctx):
    """The candidate with the lowest mean validation MAE, which the forecast and the plan follow."""
    return ctx.winner


# ---------------------------------------------------------------- diagnostics models
from ..operators import diagnostics_models, kpi  # noqa: E402


_Z = ", ".join(f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)" for c in diagnostics_models.SEGMENT_FEATURES)
_SEGMENT_SQL = f"""WITH RECURSIVE t AS (
  SELECT * FROM (SELECT *, {RATE_SQL} FROM (SELECT restaurant_id, {SUMS_SQL} FROM store_day_ledger GROUP BY restaurant_id))
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in diagnostics_models.SEGMENT_FEATURES)}),
z AS MATERIALIZED (SELECT restaurant_id, [{_Z}] AS z FROM t),
p AS (SELECT list(z ORDER BY restaurant_id) AS p FROM z),
l(i, s, c) AS (
  SELECT 0, s, list(z ORDER BY md5(concat_ws('|', s, restaurant_id, 42)))[1:3] FROM z, range(20) u(s) GROUP BY s
  UNION ALL
  SELECT i + 1, s, list_transform(c, lambda q, j: CASE WHEN len(list_filter(a, lambda x: x = j)) = 0 THEN q ELSE
           list_transform(range(1, len(q) + 1), lambda d: list_avg(list_transform(list_filter(list_zip(p, a), lambda m: m[2] = j), lambda m: m[1][d]))) END)
  FROM (SELECT i, s, c, p, list_transform(p, lambda x: list_position(list_transform(c, lambda q: list_distance(x, q)), list_min(list_transform(c, lambda q: list_distance(x, q))))) AS a
        FROM l, p WHERE i < 40)),
best AS (
  SELECT c FROM l, p WHERE i = 40
  ORDER BY round(list_sum(list_transform(p, lambda x: pow(list_min(list_transform(c, lambda q: list_distance(x, q))), 2))), 9), s LIMIT 1),
n AS (SELECT restaurant_id, list_position(list_transform(c, lambda q: list_distance(z, q)), list_min(list_transform(c, lambda q: list_distance(z, q)))) AS j FROM z, best),
k AS (SELECT j, row_number() OVER (ORDER BY avg(operating_margin_pct), j) - 1 AS cluster_id FROM n JOIN t USING (restaurant_id) GROUP BY j)
SELECT t.restaurant_id, r.restaurant_name, r.location_type, {', '.join('t.' + c for c in diagnostics_models.SEGMENT_FEATURES)}, cluster_id,
       {[*diagnostics_models.SEGMENT_NAMES]!r}[cluster_id + 1] AS store_segment
FROM t JOIN n USING (restaurant_id) JOIN k USING (j) JOIN restaurants r USING (restaurant_id)"""


@query(
    "d01_store_segments",
    typed(
        with_ctes(["store_day_ledger", "restaurants"], _SEGMENT_SQL),
        "restaurant_id:i, restaurant_name:s, location_type:s, " + "".join(f"{c}:d, " for c in diagnostics_models.SEGMENT_FEATURES) + "cluster_id:i, store_segment:s",
    ),
)
def d01_store_segments(ctx):
    """k-means (k=3, best of 20 seeds) on standardised site rates, named by margin rank."""
    totals = kpi.store_totals(ctx.store_day, ctx.restaurants)
    seg = diagnostics_models.site_segments(totals)
    return seg.select(
        "restaurant_id", "restaurant_name", "location_type", *diagnostics_models.SEGMENT_FEATURES,
        "cluster_id", "store_segment",
    )


# The oracle solves the dense normal equations (a column per site, weekday and month) by elimination.
cte(
    "staffing_residuals",
    ["store_day_ledger"],
    """WITH RECURSIVE s AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY restaurant_id, business_date) AS r, * FROM (
    SELECT restaurant_id, business_date, weekday, month, transactions, transactions / nullif(service_hours * 6, 0) AS x, satisfaction_score AS y
    FROM store_day_ledger WHERE survey_responses >= 3)
  WHERE x IS NOT NULL AND y IS NOT NULL),
e AS MATERIALIZED (
  SELECT r, 's' || restaurant_id AS f, 1.0::DOUBLE AS v FROM s UNION ALL SELECT r, 'd' || weekday, 1.0 FROM s
  UNION ALL SELECT r, 'm' || month, 1.0 FROM s UNION ALL SELECT r, 'l', ln(1 + transactions) FROM s),
t AS (SELECT count(*)::DOUBLE AS n, avg(x) AS mx, avg(y) AS my FROM s),
f AS MATERIALIZED (SELECT f, row_number() OVER (ORDER BY f) AS j, sum(v) / (SELECT n FROM t) AS m FROM e GROUP BY f),
a AS (SELECT p.f AS p, q.f AS q, sum(p.v * q.v) AS v FROM e p JOIN e q USING (r) GROUP BY p.f, q.f),
b AS (SELECT f, sum(v * x) AS bx, sum(v * y) AS by_ FROM e JOIN s USING (r) GROUP BY f),
rows_ AS (
  SELECT p.f, p.j, list(coalesce(a.v, 0) - t.n * p.m * q.m + CASE WHEN p.j = q.j THEN 1.0 ELSE 0.0 END ORDER BY q.j) AS left_
  FROM f p CROSS JOIN f q CROSS JOIN t LEFT JOIN a ON a.p = p.f AND a.q = q.f GROUP BY p.f, p.j),
g(i, m) AS (
  SELECT 0, list(list_concat(left_, [bx - n * f.m * mx, by_ - n * f.m * my]) ORDER BY rows_.j)
  FROM rows_ JOIN b USING (f) JOIN f USING (f) CROSS JOIN t
  UNION ALL
  SELECT i + 1, list_transform(m, lambda w, k: CASE WHEN k = i + 1 THEN list_transform(w, lambda z: z / w[i + 1])
           ELSE list_transform(list_zip(w, m[i + 1]), lambda z: z[1] - w[i + 1] / m[i + 1][i + 1] * z[2]) END)
  FROM g WHERE i < len(m)),
solved AS MATERIALIZED (SELECT f.f, f.m, m.m[f.j][-2] AS wx, m.m[f.j][-1] AS wy FROM f, (SELECT m FROM g ORDER BY i DESC LIMIT 1) m),
p AS (SELECT r, sum(v * wx) AS px, sum(v * wy) AS py FROM e JOIN solved USING (f) GROUP BY r),
c AS (SELECT sum(m * wx) AS cx, sum(m * wy) AS cy FROM solved)
SELECT restaurant_id, business_date, x - mx - px + cx AS x_res, y - my - py + cy AS y_res FROM s JOIN p USING (r) CROSS JOIN c CROSS JOIN t""",
)
cte(
    "site_resamples",
    ["staffing_residuals"],
    """WITH u AS (
  SELECT row_number() OVER (ORDER BY restaurant_id) - 1 AS k, count(*)::DOUBLE AS n, sum(x_res) AS sx, sum(y_res) AS sy,
         sum(x_res * x_res) AS sxx, sum(y_res * y_res) AS syy, sum(x_res * y_res) AS sxy
  FROM staffing_residuals GROUP BY restaurant_id),
d AS (
  SELECT rep, ('0x' || substr(md5(concat_ws('|', rep, pos, 42)), 1, 8))::BIGINT % (SELECT count(*) FROM u) AS k
  FROM range(400) a(rep), range((SELECT count(*) FROM u)) b(pos)),
q AS (SELECT rep, sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(syy) AS syy, sum(sxy) AS sxy FROM d JOIN u USING (k) GROUP BY rep)
SELECT rep, (n * sxy - sx * sy) / nullif(sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)), 0) AS correlation FROM q""",
)


@query(
    "d03_staffing_association",
    typed(
        with_ctes(
            ["site_resamples"],
            """SELECT (SELECT corr(x_res, y_res) FROM staffing_residuals) AS controlled_correlation,
       quantile_cont(correlation, 0.025) AS ci_low, quantile_cont(correlation, 0.975) AS ci_high,
       (SELECT count(*) FROM staffing_residuals) AS store_days,
       'Correlation of ridge residuals; sites resampled with their residuals kept' AS method,
       'An association only: who answers a survey is not random' AS interpretation
FROM site_resamples""",
        ),
        "controlled_correlation:d, ci_low:d, ci_high:d, store_days:i, method:s, interpretation:s",
    ),
)
def d03_staffing_association(ctx):
    """Residualised service-pressure / satisfaction correlation with a site bootstrap range."""
    return diagnostics_models.staffing_association(ctx.store_day)


@query(
    "d04_association_bootstrap",
    typed(with_ctes(["site_resamples"], "SELECT rep, correlation FROM site_resamples"), "rep:i, correlation:d"),
)
def d04_association_bootstrap(ctx):
    """The 400 site-resample correlations behind the D03 range."""
    res = diagnostics_models.residualised(diagnostics_models.association_sample(ctx.store_day))
    return diagnostics_models.site_bootstrap(res)


@query("f04_gbt_backtest")
def f04_gbt_backtest(ctx):
    """Histogram-boosting challenger: 120 iterations, 15 leaves, step 0.06, L2 8, recursive
    28-day traces per fold and holdout (F04, F05); pytest compares the trees with numpy."""
    return ctx.boosted_traces.select(
        "restaurant_id", "business_date", "horizon_day", "forecast_revenue", "model", "origin_date",
        "evaluation_period", "fold", "actual_revenue",
    )


@query("f08_three_model_comparison")
def f08_three_model_comparison(ctx):
    """Seasonal naive, calendar ridge and GBT metrics per period and fold, with the
    mean-validation-MAE winner flagged; the holdout never selects (F06, F08)."""
    return _comparison(ctx, boosted=True)


@query("x10_findings")
def x10_findings(ctx):
    """Eight evidence-backed findings with formatted evidence sentences."""
    from ..operators import diagnostics, feeds, findings, marts, promotions
    from .q_analysis import _profiles
    from .q_promotions import _effects

    latest = diagnostics.latest_opportunities(ctx.store_month_kpis, ctx.restaurants, "2025-10")
    return findings.findings(
        peer_gaps=feeds.peer_margin_gaps(latest),
        store_hour=ctx.store_hour,
        opportunities=latest,
        promotion_summary=promotions.promotion_summary(_effects(ctx)),
        categories=diagnostics.category_contribution(marts.product_month(ctx.transactions, ctx.products)),
        profiles=_profiles(ctx),
        association=diagnostics_models.staffing_association(ctx.store_day),
        model_metrics=_comparison(ctx),
        forecast_daily=ctx.forecast_daily,
    )


@query(
    "f10_winner_forecast",
    typed(
        with_ctes(["forecast_daily"], "SELECT * FROM forecast_daily"),
        "restaurant_id:i, business_date:t, origin_date:t, forecast_revenue:d, lower_80:d, upper_80:d, model:s",
    ),
)
def f10_winner_forecast(ctx):
    """Final 28-day refit of the validation winner, with that model's empirical 80 % bands and its name (F08 -> F09 -> F10)."""
    return ctx.forecast_daily.select("restaurant_id", "business_date", "origin_date", "forecast_revenue", "lower_80", "upper_80", "model")
