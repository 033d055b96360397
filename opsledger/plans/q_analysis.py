"""Analysis queries: customers, anomalies, correlations, staffing, promotions, forecasts."""

from __future__ import annotations

from ..operators import customers
from .oracle_base import cte, msum, typed, with_ctes
from .registry import query

cte(
    "customer_profiles",
    ["orders_mart", "loyalty"],
    f"""WITH ident AS (SELECT * FROM orders_mart WHERE customer_id IS NOT NULL),
asof_d AS (SELECT max(business_date) AS d FROM ident),
fv AS (SELECT customer_id, min(business_date) AS first_visit FROM ident GROUP BY customer_id),
e AS (SELECT i.*, fv.first_visit, i.business_date - fv.first_visit AS days
      FROM ident i JOIN fv USING (customer_id)),
c AS (SELECT customer_id, min(first_visit) AS first_visit, max(business_date) AS last_visit,
             count(DISTINCT business_date) AS visits, count(*) AS orders, {msum('revenue')} AS spend,
             arg_min(restaurant_id, (business_date, order_id)) AS restaurant_id,
             bool_or(days BETWEEN 1 AND 90) AS rep, bool_or(days BETWEEN 31 AND 90) AS later,
             count(DISTINCT CASE WHEN days BETWEEN 0 AND 30 THEN business_date END) AS early_visits
      FROM e GROUP BY customer_id),
red AS (SELECT DISTINCT l.customer_id FROM loyalty l JOIN fv USING (customer_id)
        WHERE l.event_type = 'Redeem' AND l.event_date - fv.first_visit BETWEEN 0 AND 30),
r AS (SELECT c.*, (SELECT d FROM asof_d) - last_visit AS recency_days,
             first_visit <= (SELECT d FROM asof_d) - 90 AS eligible_90d,
             red.customer_id IS NOT NULL AS early_redemption
      FROM c LEFT JOIN red USING (customer_id))
SELECT customer_id, first_visit, last_visit, visits, orders, spend, restaurant_id, recency_days,
       CASE WHEN recency_days <= 30 AND visits >= 12 THEN 'Champions'
            WHEN recency_days > 90 THEN 'Lapsed'
            WHEN visits <= 2 AND recency_days <= 30 THEN 'New / occasional'
            WHEN visits >= 6 THEN 'Regulars' ELSE 'Developing' END AS segment,
       eligible_90d,
       CASE WHEN eligible_90d THEN CAST(rep AS INTEGER) END AS repeat_within_90d,
       CASE WHEN eligible_90d THEN CAST(later AS INTEGER) END AS return_days31_90,
       early_redemption, early_visits,
       CASE WHEN early_visits <= 0 THEN 'nan' WHEN early_visits <= 1 THEN '1 visit'
            WHEN early_visits <= 3 THEN '2–3 visits' ELSE '4+ visits' END AS early_activity_band,
       strftime(first_visit, '%Y-%m') AS cohort_month
FROM r""",
)

PROFILE_SPEC = (
    "customer_id:i, first_visit:t, last_visit:t, visits:i, orders:i, spend:d, restaurant_id:i, recency_days:i, "
    "segment:s, eligible_90d:b, repeat_within_90d:i, return_days31_90:i, early_redemption:b, early_visits:i, "
    "early_activity_band:s, cohort_month:s"
)


def _profiles(ctx):
    return customers.customer_profiles(ctx.orders, ctx.loyalty)


@query("c01_customer_segments", typed(with_ctes(["customer_profiles"], "SELECT * FROM customer_profiles"), PROFILE_SPEC))
def c01_customer_segments(ctx):
    """RFM profile, ordered segment rules, 90-day eligibility/repeat, early visits and
    redemption per identified customer (C01-C05, J07, N14)."""
    return _profiles(ctx)


@query(
    "c06_customer_cohorts",
    typed(
        with_ctes(
            ["customer_profiles"],
            """SELECT restaurant_id, cohort_month, count(*) AS identified_customers,
       count(*) FILTER (WHERE eligible_90d) AS eligible_customers, sum(repeat_within_90d) AS repeat_customers,
       sum(repeat_within_90d) / nullif(count(*) FILTER (WHERE eligible_90d), 0) AS repeat_customer_rate
FROM customer_profiles GROUP BY restaurant_id, cohort_month""",
        ),
        "restaurant_id:i, cohort_month:s, identified_customers:i, eligible_customers:i, repeat_customers:i, "
        "repeat_customer_rate:d",
    ),
)
def c06_customer_cohorts(ctx):
    """Repeat cohorts by site and first-visit month."""
    return customers.cohorts(_profiles(ctx))


@query(
    "c07_loyalty_behaviours",
    typed(
        with_ctes(
            ["customer_profiles"],
            """SELECT early_activity_band, early_redemption, count(*) AS customers,
       sum(return_days31_90) AS later_returners, sum(return_days31_90) / nullif(count(*), 0) AS later_return_rate
FROM customer_profiles WHERE eligible_90d GROUP BY early_activity_band, early_redemption""",
        ),
        "early_activity_band:s, early_redemption:b, customers:i, later_returners:i, later_return_rate:d",
    ),
)
def c07_loyalty_behaviours(ctx):
    """Later-return rate by early activity band and early redemption."""
    return customers.behaviours(_profiles(ctx))


@query(
    "a37_segment_summary",
    typed(
        with_ctes(
            ["customer_profiles"],
            """SELECT restaurant_id, segment, count(*) AS customers, sum(spend) AS spend, sum(visits) AS visits,
       count(*) FILTER (WHERE eligible_90d) AS eligible_customers, sum(repeat_within_90d) AS repeat_customers
FROM customer_profiles GROUP BY restaurant_id, segment""",
        ),
        "restaurant_id:i, segment:s, customers:i, spend:d, visits:i, eligible_customers:i, repeat_customers:i",
    ),
)
def a37_segment_summary(ctx):
    """Segment summary per site."""
    return customers.segment_summary(_profiles(ctx))


@query(
    "w09_first_order",
    typed(
        with_ctes(
            ["orders_mart"],
            """SELECT customer_id, order_id, restaurant_id, business_date, revenue FROM (
  SELECT customer_id, order_id, restaurant_id, business_date, revenue,
         row_number() OVER (PARTITION BY customer_id ORDER BY business_date, order_id) AS rn
  FROM orders_mart WHERE customer_id IS NOT NULL) WHERE rn = 1""",
        ),
        "customer_id:i, order_id:i, restaurant_id:i, business_date:t, revenue:d",
    ),
)
def w09_first_order(ctx):
    """First order per customer by (date, order id)."""
    o = ctx.orders.filter("customer_id IS NOT NULL").select(
        "customer_id", "order_id", "restaurant_id", "business_date", "revenue"
    )
    return customers.first_events(o, "customer_id", ["business_date", "order_id"])


# ---------------------------------------------------------------- diagnostics
from ..operators import diagnostics, kpi, marts  # noqa: E402

RATE_SQL = """revenue - ingredient_cost AS gross_contribution,
       revenue / nullif(transactions, 0) AS average_transaction_value,
       (revenue - ingredient_cost) / nullif(revenue, 0) AS gross_margin_pct,
       operating_profit / nullif(revenue, 0) AS operating_margin_pct,
       labour_cost / nullif(revenue, 0) AS labour_cost_pct,
       revenue / nullif(paid_hours, 0) AS sales_per_labour_hour,
       transactions / nullif(paid_hours, 0) AS transactions_per_labour_hour,
       waste_cost / nullif(ingredient_cost + waste_cost, 0) AS waste_pct,
       score_sum / nullif(survey_responses, 0) AS satisfaction_score,
       identified_orders / nullif(transactions, 0) AS identified_order_share,
       late_deliveries / nullif(deliveries, 0) AS late_delivery_pct"""
SUMS_SQL = ", ".join(f"{msum(c) if c in kpi.MONEY else f'sum({c})'} AS {c}" for c in kpi.ADDITIVE)
RATE_COLS = (
    "gross_contribution average_transaction_value gross_margin_pct operating_margin_pct labour_cost_pct "
    "sales_per_labour_hour transactions_per_labour_hour waste_pct satisfaction_score identified_order_share "
    "late_delivery_pct"
).split()
_INTS = {"transactions", "identified_orders", "survey_responses", "deliveries", "late_deliveries"}
LEDGER_SPEC = ", ".join(f"{c}:{'i' if c in _INTS else 'd'}" for c in kpi.ADDITIVE + RATE_COLS)

ANOM_SQL = """WITH b AS (
  SELECT restaurant_id, restaurant_name, business_date, weekday, revenue, is_public_holiday, promotion_id,
         list_sort(list(revenue) OVER w) AS prior
  FROM store_day_ledger
  WINDOW w AS (PARTITION BY restaurant_id, weekday ORDER BY business_date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
m AS (SELECT *, coalesce(len(prior), 0) AS n,
             (prior[(len(prior) + 1) // 2] + prior[len(prior) // 2 + 1]) / 2.0 AS med FROM b),
z AS (SELECT *, CASE WHEN n >= 8 THEN med END AS prior_median,
             CASE WHEN n = 12 THEN (list_sort(list_transform(prior, lambda x: abs(x - med)))[6]
                                    + list_sort(list_transform(prior, lambda x: abs(x - med)))[7]) / 2.0 END AS prior_mad
      FROM m)
SELECT restaurant_id, restaurant_name, business_date, weekday, revenue, is_public_holiday, promotion_id,
       prior_median, prior_mad, 0.6745 * (revenue - prior_median) / nullif(prior_mad, 0) AS robust_z,
       coalesce(abs(0.6745 * (revenue - prior_median) / nullif(prior_mad, 0)) > 3.5, false) AS is_anomaly
FROM z"""


@query(
    "d02_sales_anomalies",
    typed(
        with_ctes(["store_day_ledger"], ANOM_SQL),
        "restaurant_id:i, restaurant_name:s, business_date:t, weekday:i, revenue:d, is_public_holiday:i, "
        "promotion_id:s, prior_median:d, prior_mad:d, robust_z:d, is_anomaly:b",
    ),
)
def d02_sales_anomalies(ctx):
    """Robust same-weekday sales anomalies with prior-only rolling median/MAD."""
    d = ctx.store_day.select(
        "restaurant_id", "restaurant_name", "business_date", "weekday", "revenue", "is_public_holiday", "promotion_id"
    )
    return diagnostics.sales_anomalies(d)


_PAIRS = [(a, b) for a in diagnostics.CORR_FIELDS for b in diagnostics.CORR_FIELDS]
CORR_SQL = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS metric, '{b}' AS other, corr({a}, {b}) AS correlation FROM store_month_kpis" for a, b in _PAIRS
)


@query("a25_kpi_correlations", typed(with_ctes(["store_month_kpis"], CORR_SQL), "metric:s, other:s, correlation:d"))
def a25_kpi_correlations(ctx):
    """Pairwise-complete correlation matrix of seven monthly KPIs in one aggregate."""
    return diagnostics.kpi_correlations(ctx.store_month_kpis)


@query(
    "a26_driver_ranking",
    typed(
        with_ctes(
            ["store_month_kpis"],
            f"""SELECT *, row_number() OVER (ORDER BY abs(correlation) DESC NULLS LAST, other) AS rank
FROM ({CORR_SQL}) WHERE metric = 'operating_margin_pct' AND other <> 'operating_margin_pct'""",
        ),
        "metric:s, other:s, correlation:d, rank:i",
    ),
)
def a26_driver_ranking(ctx):
    """KPI correlations with operating margin ranked by absolute size."""
    return diagnostics.driver_ranking(diagnostics.kpi_correlations(ctx.store_month_kpis))


@query(
    "a27_store_totals",
    typed(
        with_ctes(
            ["store_day_ledger", "restaurants"],
            f"""SELECT s.*, r.restaurant_name, r.state, r.location_type, r.area FROM (
  SELECT *, {RATE_SQL} FROM (SELECT restaurant_id, {SUMS_SQL} FROM store_day_ledger GROUP BY restaurant_id)) s
JOIN restaurants r USING (restaurant_id)""",
        ),
        "restaurant_id:i, restaurant_name:s, state:s, location_type:s, area:s, " + LEDGER_SPEC,
    ),
)
def a27_store_totals(ctx):
    """Full-history site totals with recomputed rates."""
    cols = ["restaurant_id", "restaurant_name", "state", "location_type", "area"] + kpi.ADDITIVE + RATE_COLS
    return kpi.store_totals(ctx.store_day, ctx.restaurants).select(*cols)


@query(
    "a28_latest_opportunities",
    typed(
        with_ctes(
            ["store_month_kpis", "restaurants"],
            f"""WITH latest AS (SELECT * FROM store_month_kpis WHERE month >= '2025-10'),
p AS (SELECT *, {RATE_SQL} FROM (SELECT restaurant_id, {SUMS_SQL} FROM latest GROUP BY restaurant_id)),
j AS (SELECT p.*, r.location_type, i.performance_index FROM p JOIN restaurants r USING (restaurant_id)
      JOIN (SELECT restaurant_id, avg(performance_index) AS performance_index FROM latest GROUP BY restaurant_id) i
      USING (restaurant_id)),
k AS (SELECT j.*, median(waste_pct) OVER (PARTITION BY location_type) AS waste_peer_median FROM j)
SELECT restaurant_id, location_type, revenue, operating_margin_pct, labour_cost_pct, waste_pct, satisfaction_score,
       performance_index, waste_peer_median,
       CASE WHEN waste_pct - waste_peer_median IS NOT NULL THEN greatest(waste_pct - waste_peer_median, 0) END
         * (ingredient_cost + waste_cost) AS estimated_waste_opportunity
FROM k""",
        ),
        "restaurant_id:i, location_type:s, revenue:d, operating_margin_pct:d, labour_cost_pct:d, waste_pct:d, "
        "satisfaction_score:d, performance_index:d, waste_peer_median:d, estimated_waste_opportunity:d",
    ),
)
def a28_latest_opportunities(ctx):
    """Latest-quarter rates, mean index and peer-median waste opportunity."""
    return diagnostics.latest_opportunities(ctx.store_month_kpis, ctx.restaurants, "2025-10").select(
        "restaurant_id", "location_type", "revenue", "operating_margin_pct", "labour_cost_pct", "waste_pct",
        "satisfaction_score", "performance_index", "waste_peer_median", "estimated_waste_opportunity",
    )


@query(
    "a29_staffing_patterns",
    typed(
        with_ctes(
            ["store_hour"],
            """SELECT restaurant_id, weekday, hour, avg(transactions) AS transactions,
       CAST(sum(CAST(round(service_capacity_orders * 1000000) AS BIGINT)) AS DOUBLE) / 1000000.0::DOUBLE
         / count(service_capacity_orders) AS capacity,
       count(*) FILTER (WHERE staffing_status = 'Pressure') AS pressure_hours, count(*) AS observations,
       count(*) FILTER (WHERE staffing_status = 'Spare capacity') AS spare_hours,
       count(*) FILTER (WHERE staffing_status = 'Pressure') / count(*) AS pressure_share
FROM store_hour GROUP BY restaurant_id, weekday, hour""",
        ),
        "restaurant_id:i, weekday:i, hour:i, transactions:d, capacity:d, pressure_hours:i, observations:i, "
        "spare_hours:i, pressure_share:d",
    ),
)
def a29_staffing_patterns(ctx):
    """Demand, capacity and pressure/spare counts by site, weekday, hour."""
    return diagnostics.staffing_patterns(ctx.store_hour)


_HM = ", ".join(
    f"avg(CASE WHEN staffing_status = 'Pressure' THEN 1.0 ELSE 0.0 END) FILTER (WHERE hour = {h}) AS h{h}"
    for h in range(11, 22)
)


@query(
    "a32_pressure_heatmap",
    typed(
        with_ctes(["store_hour"], f"SELECT weekday, {_HM} FROM store_hour GROUP BY weekday"),
        "weekday:i, " + ", ".join(f"h{h}:d" for h in range(11, 22)),
    ),
)
def a32_pressure_heatmap(ctx):
    """Weekday x hour pressure share as a pivot."""
    return diagnostics.pressure_heatmap(ctx.store_hour)


@query(
    "a35_peak_shares",
    typed(
        with_ctes(
            ["store_hour"],
            """SELECT avg(CASE WHEN staffing_status = 'Pressure' THEN 1.0 ELSE 0.0 END) FILTER (WHERE hour IN (12, 13, 18, 19)) AS peak_pressure_share,
       avg(CASE WHEN staffing_status = 'Pressure' THEN 1.0 ELSE 0.0 END) FILTER (WHERE hour IN (14, 15, 16, 17)) AS off_peak_pressure_share,
       avg(CASE WHEN staffing_status = 'Spare capacity' THEN 1.0 ELSE 0.0 END) FILTER (WHERE hour IN (12, 13, 18, 19)) AS peak_spare_share,
       avg(CASE WHEN staffing_status = 'Spare capacity' THEN 1.0 ELSE 0.0 END) FILTER (WHERE hour IN (14, 15, 16, 17)) AS off_peak_spare_share,
       avg(CASE WHEN staffing_status = 'Pressure' THEN 1.0 ELSE 0.0 END) AS pressure_hour_share
FROM store_hour""",
        ),
        "peak_pressure_share:d, off_peak_pressure_share:d, peak_spare_share:d, off_peak_spare_share:d, "
        "pressure_hour_share:d",
    ),
)
def a35_peak_shares(ctx):
    """Peak vs off-peak pressure and spare-capacity shares."""
    return diagnostics.peak_shares(ctx.store_hour)


@query(
    "a31_chain_trend",
    typed(
        with_ctes(
            ["store_day_ledger"],
            f"SELECT *, {RATE_SQL} FROM (SELECT month, {SUMS_SQL} FROM store_day_ledger GROUP BY month)",
        ),
        "month:s, " + LEDGER_SPEC,
    ),
)
def a31_chain_trend(ctx):
    """Chain totals and rates by month."""
    return diagnostics.chain_trend(ctx.store_day).select("month", *kpi.ADDITIVE, *RATE_COLS)


_CAT_SQL = f"""SELECT category, {msum('net_revenue')} AS revenue, {msum('ingredient_cost')} AS ingredient_cost,
       sum(quantity) AS units FROM transactions t JOIN products p USING (product_id) GROUP BY category"""


@query(
    "a33_category_contribution",
    typed(
        with_ctes(
            ["transactions", "products"],
            f"""SELECT *, revenue - ingredient_cost AS gross_contribution,
       (revenue - ingredient_cost) / nullif(revenue, 0) AS gross_margin_pct FROM ({_CAT_SQL})""",
        ),
        "category:s, revenue:d, ingredient_cost:d, units:i, gross_contribution:d, gross_margin_pct:d",
    ),
)
def a33_category_contribution(ctx):
    """Category contribution and margin."""
    pm = marts.product_month(ctx.transactions, ctx.products)
    return diagnostics.category_contribution(pm)


@query(
    "k03_category_leaders",
    typed(
        with_ctes(
            ["transactions", "products"],
            f"""SELECT arg_max(category, (revenue, category)) AS top_category,
       arg_max(category, ((revenue - ingredient_cost) / nullif(revenue, 0), category)) AS highest_margin_category
FROM ({_CAT_SQL})""",
        ),
        "top_category:s, highest_margin_category:s",
    ),
)
def k03_category_leaders(ctx):
    """Arg-max category by revenue and by margin."""
    pm = marts.product_month(ctx.transactions, ctx.products)
    return diagnostics.category_leaders(diagnostics.category_contribution(pm))


# ---------------------------------------------------------------- forecasting
from ..operators import forecast  # noqa: E402
from ..sources.adapters import HISTORY_END  # noqa: E402

_ORIGINS = [(p, k, f"DATE '{HISTORY_END}' - {back}") for p, k, back in forecast.folds(HISTORY_END)]
TRACE_SQL = f"""WITH o(evaluation_period, fold, origin_date) AS (VALUES {', '.join(f"('{p}', {k}, CAST({d} AS DATE))" for p, k, d in _ORIGINS)}),
f AS (
  SELECT r.restaurant_id, CAST(o.origin_date + h AS DATE) AS business_date, h AS horizon_day,
         o.origin_date, o.evaluation_period, o.fold,
         CAST(o.origin_date - 6 + ((h - 1) % 7) AS DATE) AS src
  FROM restaurants r, o, (SELECT CAST(range AS INTEGER) AS h FROM range(1, 29)) t)
SELECT f.restaurant_id, f.business_date, f.horizon_day,
       CASE WHEN s.revenue IS NOT NULL THEN greatest(s.revenue, 0.0) END AS forecast_revenue,
       'Seasonal naive' AS model, f.origin_date, f.evaluation_period, f.fold, a.revenue AS actual_revenue
FROM f LEFT JOIN store_day_ledger s ON s.restaurant_id = f.restaurant_id AND s.business_date = f.src
JOIN store_day_ledger a ON a.restaurant_id = f.restaurant_id AND a.business_date = f.business_date"""
TRACE_SPEC = (
    "restaurant_id:i, business_date:t, horizon_day:i, forecast_revenue:d, model:s, origin_date:t, "
    "evaluation_period:s, fold:i, actual_revenue:d"
)
cte("traces", ["restaurants", "store_day_ledger"], TRACE_SQL)
from . import oracle_ridge  # noqa: E402,F401


def _traces(ctx):
    hist = ctx.store_day.select("restaurant_id", "business_date", "revenue")
    return forecast.backtest(hist, ctx.restaurants.select("restaurant_id"), HISTORY_END)


@query("f07_naive_backtest", typed(with_ctes(["traces"], "SELECT * FROM traces"), TRACE_SPEC))
def f07_naive_backtest(ctx):
    """Rolling-origin seasonal-naive traces: 3 validation folds + holdout."""
    return _traces(ctx)


_MET = f"""SELECT evaluation_period, fold, model,
       avg(abs(actual_revenue - forecast_revenue)) AS mae,
       sqrt(avg((actual_revenue - forecast_revenue) * (actual_revenue - forecast_revenue))) AS rmse,
       avg(CASE WHEN actual_revenue > 0 THEN abs(actual_revenue - forecast_revenue) / actual_revenue END) * 100 AS mape,
       sum(abs(actual_revenue - forecast_revenue)) / nullif(sum(actual_revenue), 0) * 100 AS wape,
       count(*) AS observations
FROM traces GROUP BY evaluation_period, fold, model"""


@query(
    "f06_forecast_metrics",
    typed(
        with_ctes(["traces"], _MET),
        "evaluation_period:s, fold:i, model:s, mae:d, rmse:d, mape:d, wape:d, observations:i",
    ),
)
def f06_forecast_metrics(ctx):
    """MAE / RMSE / MAPE / WAPE per fold and period (F06, F08 input)."""
    return forecast.metrics(_traces(ctx), ["evaluation_period", "fold", "model"])


_BANDS = """WITH b AS (SELECT restaurant_id, quantile_cont(abs(actual_revenue - forecast_revenue), 0.8) AS band
           FROM traces WHERE evaluation_period = 'Validation' GROUP BY restaurant_id),
h AS (SELECT t.*, CASE WHEN t.forecast_revenue - b.band IS NOT NULL THEN greatest(t.forecast_revenue - b.band, 0.0) END AS lower_80,
             t.forecast_revenue + b.band AS upper_80
      FROM traces t LEFT JOIN b USING (restaurant_id) WHERE t.evaluation_period = 'Holdout')
SELECT restaurant_id, count(*) AS observations,
       avg(CASE WHEN actual_revenue BETWEEN lower_80 AND upper_80 THEN 1.0 ELSE 0.0 END) AS interval_coverage,
       min(lower_80) AS min_lower_80, max(upper_80) AS max_upper_80
FROM h GROUP BY restaurant_id"""


@query(
    "f09_holdout_coverage",
    typed(
        with_ctes(["traces"], _BANDS),
        "restaurant_id:i, observations:i, interval_coverage:d, min_lower_80:d, max_upper_80:d",
    ),
)
def f09_holdout_coverage(ctx):
    """Per-site P80 validation error bands and holdout coverage."""
    from pyspark.sql import functions as F

    t = _traces(ctx)
    h = forecast.with_bands(t.filter(F.col("evaluation_period") == "Holdout"), forecast.error_bands(t))
    covered = F.col("actual_revenue").between(F.col("lower_80"), F.col("upper_80")).cast("double")
    return h.groupBy("restaurant_id").agg(
        F.count(F.lit(1)).alias("observations"),
        F.avg(F.coalesce(covered, F.lit(0.0))).alias("interval_coverage"),
        F.min("lower_80").alias("min_lower_80"),
        F.max("upper_80").alias("max_upper_80"),
    )


@query(
    "f11_forecast_plot",
    typed(
        with_ctes(
            ["store_day_ledger", "forecast_daily"],
            """SELECT restaurant_id, business_date, revenue, CAST(NULL AS DOUBLE) AS lower_80, CAST(NULL AS DOUBLE) AS upper_80,
       'History' AS record_kind FROM store_day_ledger
UNION ALL
SELECT restaurant_id, business_date, forecast_revenue, lower_80, upper_80, 'Forecast estimate' FROM forecast_daily""",
        ),
        "restaurant_id:i, business_date:t, revenue:d, lower_80:d, upper_80:d, record_kind:s",
    ),
)
def f11_forecast_plot(ctx):
    """The chosen model's forecast with bands, unioned with history."""
    from pyspark.sql import functions as F

    fut = ctx.forecast_daily.select(
        "restaurant_id", "business_date", F.col("forecast_revenue").alias("revenue"), "lower_80", "upper_80",
        F.lit("Forecast estimate").alias("record_kind"),
    )
    return ctx.revenue_history.withColumn("record_kind", F.lit("History")).unionByName(fut, allowMissingColumns=True)


# ---------------------------------------------------------------- promotions
from ..operators import promotions  # noqa: E402

CONTROL_SQL = """WITH c AS (SELECT p.*, r.location_type FROM promotions p JOIN restaurants r USING (restaurant_id)),
ctrl AS (
  SELECT c.promotion_id, r.restaurant_id AS other_id FROM c JOIN restaurants r
    ON r.location_type = c.location_type AND r.restaurant_id <> c.restaurant_id
  WHERE NOT EXISTS (SELECT 1 FROM promotions o WHERE o.restaurant_id = r.restaurant_id
                    AND o.start_date <= c.end_date AND o.end_date >= c.start_date - 14)),
l AS (SELECT promotion_id, list_sort(list(other_id)) AS ids FROM ctrl GROUP BY promotion_id)
SELECT p.promotion_id, p.restaurant_id, p.campaign_name, p.start_date, p.end_date, p.discount_rate, p.campaign_cost,
       coalesce(len(l.ids), 0) AS control_stores,
       '[' || coalesce(array_to_string(l.ids, ', '), '') || ']' AS control_restaurant_ids,
       CAST(p.start_date - 14 AS DATE) AS comparison_start,
       CASE WHEN coalesce(len(l.ids), 0) = 0 THEN 'No eligible control stores' ELSE 'Exploratory matched estimate' END
         AS estimate_status
FROM promotions p LEFT JOIN l USING (promotion_id)"""


@query(
    "m01_control_selection",
    typed(
        with_ctes(["promotions", "restaurants"], CONTROL_SQL),
        "promotion_id:s, restaurant_id:i, campaign_name:s, start_date:t, end_date:t, discount_rate:d, "
        "campaign_cost:d, control_stores:i, control_restaurant_ids:s, comparison_start:t, estimate_status:s",
    ),
)
def m01_control_selection(ctx):
    """Matched peer controls minus campaign-contaminated sites."""
    return promotions.control_selection(ctx.promotions, ctx.restaurants)
