"""Report feeds: peer margin gaps, segment / cohort / category / waste roll-ups,
weekly forecast, hourly demand mix, cost shares (A34, A36, A39, A42)."""

from __future__ import annotations

from ..operators import diagnostics, feeds, kpi, management, marts
from ..operators.marts import COSTS
from .oracle_base import cte, msum, typed, with_ctes
from .q_analysis import LEDGER_SPEC, RATE_COLS, RATE_SQL, SUMS_SQL, _profiles
from .registry import query

cte(
    "latest_perf",
    ["store_month_kpis", "restaurants"],
    f"""WITH latest AS (SELECT * FROM store_month_kpis WHERE month >= '2025-10')
SELECT p.*, r.location_type FROM (
  SELECT *, {RATE_SQL} FROM (SELECT restaurant_id, {SUMS_SQL} FROM latest GROUP BY restaurant_id)) p
JOIN restaurants r USING (restaurant_id)""",
)


@query(
    "a36_peer_margin_gaps",
    typed(
        with_ctes(
            ["latest_perf"],
            """SELECT p.restaurant_id, p.location_type, p.revenue, p.operating_profit, p.operating_margin_pct,
       p.labour_cost_pct, p.waste_pct,
       (SELECT sum(q.operating_profit) / nullif(sum(q.revenue), 0) FROM latest_perf q
        WHERE q.location_type = p.location_type AND q.restaurant_id <> p.restaurant_id) AS peer_margin_pct,
       p.operating_margin_pct - (SELECT sum(q.operating_profit) / nullif(sum(q.revenue), 0) FROM latest_perf q
        WHERE q.location_type = p.location_type AND q.restaurant_id <> p.restaurant_id) AS margin_gap,
       p.restaurant_id = (SELECT arg_min(restaurant_id, (operating_margin_pct, restaurant_id)) FROM latest_perf)
         AS is_weakest
FROM latest_perf p""",
        ),
        "restaurant_id:i, location_type:s, revenue:d, operating_profit:d, operating_margin_pct:d, labour_cost_pct:d, "
        "waste_pct:d, peer_margin_pct:d, margin_gap:d, is_weakest:b",
    ),
)
def a36_peer_margin_gaps(ctx):
    """Latest-quarter margin vs pooled location-peer margin; weakest site flagged."""
    latest = diagnostics.latest_opportunities(ctx.store_month_kpis, ctx.restaurants, "2025-10")
    return feeds.peer_margin_gaps(latest)


@query(
    "a34_segment_counts",
    typed(
        with_ctes(
            ["customer_profiles"],
            f"""SELECT segment, count(*) AS customers, {msum('spend')} AS spend, sum(visits) AS visits,
       avg(recency_days) AS mean_recency_days, avg(visits) AS mean_visits
FROM customer_profiles GROUP BY segment""",
        ),
        "segment:s, customers:i, spend:d, visits:i, mean_recency_days:d, mean_visits:d",
    ),
)
def a34_segment_counts(ctx):
    """Customers, spend, visits and mean recency per RFM segment."""
    return feeds.segment_counts(_profiles(ctx))


@query(
    "a34_cohort_rollup",
    typed(
        with_ctes(
            ["customer_profiles"],
            """SELECT cohort_month, count(*) AS customers, count(*) FILTER (WHERE eligible_90d) AS eligible_customers,
       coalesce(sum(repeat_within_90d), 0) AS repeat_customers,
       coalesce(sum(repeat_within_90d), 0) / nullif(count(*) FILTER (WHERE eligible_90d), 0) AS repeat_rate
FROM customer_profiles GROUP BY cohort_month""",
        ),
        "cohort_month:s, customers:i, eligible_customers:i, repeat_customers:i, repeat_rate:d",
    ),
)
def a34_cohort_rollup(ctx):
    """Chain cohort roll-up by first-visit month."""
    return feeds.cohort_rollup(_profiles(ctx))


@query(
    "a34_category_month_mix",
    typed(
        with_ctes(
            ["transactions", "products"],
            f"""SELECT t.month, p.category, {msum('t.net_revenue')} AS revenue, {msum('t.ingredient_cost')} AS ingredient_cost,
       sum(t.quantity) AS units, {msum('t.net_revenue')} - {msum('t.ingredient_cost')} AS gross_contribution
FROM transactions t JOIN products p USING (product_id) GROUP BY t.month, p.category""",
        ),
        "month:s, category:s, revenue:d, ingredient_cost:d, units:i, gross_contribution:d",
    ),
)
def a34_category_month_mix(ctx):
    """Product mix by month and category."""
    return feeds.category_month_mix(marts.product_month(ctx.transactions, ctx.products))


@query(
    "a34_waste_reasons",
    typed(
        with_ctes(
            ["waste"],
            f"SELECT reason, sum(waste_units) AS waste_units, {msum('waste_cost')} AS waste_cost, count(*) AS records "
            "FROM waste GROUP BY reason",
        ),
        "reason:s, waste_units:i, waste_cost:d, records:i",
    ),
)
def a34_waste_reasons(ctx):
    """Waste units and cost by reason."""
    return feeds.waste_reasons(ctx.waste)


@query(
    "a42_weekly_forecast",
    typed(
        with_ctes(
            ["forecast_daily"],
            """SELECT restaurant_id, CAST(date_trunc('week', business_date) AS DATE) AS week_start,
       sum(forecast_revenue) AS forecast_revenue, sum(lower_80) AS lower_80, sum(upper_80) AS upper_80,
       count(*) AS days
FROM forecast_daily GROUP BY ALL""",
        ),
        "restaurant_id:i, week_start:t, forecast_revenue:d, lower_80:d, upper_80:d, days:i",
    ),
)
def a42_weekly_forecast(ctx):
    """Weekly forecast and band totals per site."""
    return feeds.weekly_forecast(ctx.forecast_daily)


@query(
    "a42_hourly_demand_mix",
    typed(
        with_ctes(
            ["store_hour"],
            """SELECT hour, daypart, sum(transactions) AS orders,
       sum(transactions) / (SELECT sum(transactions) FROM store_hour) AS order_share
FROM store_hour GROUP BY hour, daypart""",
        ),
        "hour:i, daypart:s, orders:i, order_share:d",
    ),
)
def a42_hourly_demand_mix(ctx):
    """Share of orders in each trading hour."""
    return feeds.hourly_demand_mix(ctx.store_hour)


_SHARES = ", ".join(f"{c} / nullif(revenue, 0) AS {c}_share" for c in COSTS)


@query(
    "a42_cost_shares",
    typed(
        with_ctes(
            ["store_day_ledger"],
            f"""SELECT month, revenue, {_SHARES}, operating_profit / nullif(revenue, 0) AS operating_margin_pct
FROM (SELECT month, {msum('revenue')} AS revenue, {', '.join(f'sum({c}) AS {c}' for c in COSTS)},
             sum(operating_profit) AS operating_profit FROM store_day_ledger GROUP BY month)""",
        ),
        "month:s, revenue:d, " + ", ".join(f"{c}_share:d" for c in COSTS) + ", operating_margin_pct:d",
    ),
)
def a42_cost_shares(ctx):
    """Chain monthly cost lines as shares of revenue (A42 cost-share bridge)."""
    return feeds.cost_shares(ctx.store_day)


@query(
    "a39_forecast_store_totals",
    typed(
        with_ctes(
            ["forecast_daily"],
            "SELECT restaurant_id, sum(forecast_revenue) AS forecast_revenue, count(*) AS days FROM forecast_daily "
            "GROUP BY restaurant_id",
        ),
        "restaurant_id:i, forecast_revenue:d, days:i",
    ),
)
def a39_forecast_store_totals(ctx):
    """Forecast total per site over the next 28 days."""
    return feeds.forecast_store_totals(ctx.forecast_daily)


from .q_analysis import ANOM_SQL  # noqa: E402


@query(
    "k02_top_anomalies",
    typed(
        with_ctes(
            ["store_day_ledger"],
            f"""SELECT restaurant_id, business_date, revenue, prior_median, robust_z FROM ({ANOM_SQL})
WHERE robust_z IS NOT NULL ORDER BY abs(robust_z) DESC, restaurant_id, business_date LIMIT 10""",
        ),
        "restaurant_id:i, business_date:t, revenue:d, prior_median:d, robust_z:d",
    ),
)
def k02_top_anomalies(ctx):
    """Ten largest robust-z site-days (K02 top-k; the limit is the report)."""
    d = ctx.store_day.select(
        "restaurant_id", "restaurant_name", "business_date", "weekday", "revenue", "is_public_holiday", "promotion_id"
    )
    a = diagnostics.sales_anomalies(d)
    return feeds.top_anomalies(a).select("restaurant_id", "business_date", "revenue", "prior_median", "robust_z")


@query(
    "u02_store_dimension",
    typed(
        with_ctes(
            ["store_day_ledger"],
            "SELECT DISTINCT restaurant_id, restaurant_name, state, location_type, area FROM store_day_ledger",
        ),
        "restaurant_id:i, restaurant_name:s, state:s, location_type:s, area:s",
    ),
)
def u02_store_dimension(ctx):
    """Distinct site dimension from the daily fact."""
    return feeds.store_dimension(ctx.store_day)


@query(
    "p02_scope_lists",
    typed(
        with_ctes(
            ["store_month_kpis"],
            """SELECT state, array_to_string(list_sort(list(DISTINCT restaurant_id)), ', ') AS restaurant_ids,
       count(DISTINCT month) AS months, max(month) AS latest_month, min(month) AS first_month
FROM store_month_kpis GROUP BY state""",
        ),
        "state:s, restaurant_ids:s, months:i, latest_month:s, first_month:s",
    ),
)
def p02_scope_lists(ctx):
    """Per state: site list and month range for scope pickers."""
    return feeds.scope_lists(ctx.store_month_kpis)


@query(
    "w08_recent_tail",
    typed(
        with_ctes(
            ["store_day_ledger"],
            f"""SELECT business_date, {msum('revenue')} AS revenue, sum(transactions) AS transactions
FROM store_day_ledger WHERE business_date > (SELECT max(business_date) FROM store_day_ledger) - 56
GROUP BY business_date""",
        ),
        "business_date:t, revenue:d, transactions:i",
    ),
)
def w08_recent_tail(ctx):
    """Chain daily revenue and orders over the last 56 days of the spine."""
    from pyspark.sql import functions as F

    from ..functions.semantics import money_sum

    d = ctx.store_day
    last = d.select(F.max("business_date")).scalar()
    tail = d.filter(F.col("business_date") > F.date_sub(last, 56))
    return tail.groupBy("business_date").agg(money_sum("revenue").alias("revenue"), F.sum("transactions").alias("transactions"))


# ---------------------------------------------------------------- forecast metric feeds
from ..operators import forecast  # noqa: E402
from .q_analysis import _MET  # noqa: E402

_STORE_MET = _MET.replace("SELECT evaluation_period, fold, model,", "SELECT evaluation_period, model, restaurant_id,").replace(
    "GROUP BY evaluation_period, fold, model", "GROUP BY evaluation_period, model, restaurant_id"
)


@query(
    "f06_store_metrics",
    typed(
        with_ctes(["traces"], _STORE_MET),
        "evaluation_period:s, model:s, restaurant_id:i, mae:d, rmse:d, mape:d, wape:d, observations:i",
    ),
)
def f06_store_metrics(ctx):
    """MAE / RMSE / MAPE / WAPE per period, model and site (F06, A40 at site grain)."""
    return forecast.metrics(ctx.forecast_traces, ["evaluation_period", "model", "restaurant_id"])


@query(
    "a39_mean_fold_metrics",
    typed(
        with_ctes(
            ["traces"],
            f"""SELECT model, avg(mae) AS mean_mae, avg(rmse) AS mean_rmse, avg(mape) AS mean_mape, avg(wape) AS mean_wape,
       count(*) AS folds
FROM ({_MET}) WHERE evaluation_period = 'Validation' GROUP BY model""",
        ),
        "model:s, mean_mae:d, mean_rmse:d, mean_mape:d, mean_wape:d, folds:i",
    ),
)
def a39_mean_fold_metrics(ctx):
    """Mean validation-fold metrics per model."""
    from pyspark.sql import functions as F

    m = forecast.metrics(ctx.forecast_traces, ["evaluation_period", "fold", "model"])
    return m.filter(F.col("evaluation_period") == "Validation").groupBy("model").agg(
        F.avg("mae").alias("mean_mae"), F.avg("rmse").alias("mean_rmse"), F.avg("mape").alias("mean_mape"),
        F.avg("wape").alias("mean_wape"), F.count(F.lit(1)).alias("folds"),
    )


_CASES = ", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for a, b, c in feeds.CAPACITY_CASES)


@query(
    "a42_capacity_thresholds",
    typed(
        with_ctes(
            ["store_hour"],
            f"""WITH c(orders_per_service_hour, gap_tolerance, spare_threshold) AS (VALUES {_CASES}),
s AS (
  SELECT restaurant_id, c.*, CASE WHEN transactions - service_hours * orders_per_service_hour > gap_tolerance + 1e-9 THEN 'P'
         WHEN transactions < service_hours * orders_per_service_hour * spare_threshold - 1e-9 THEN 'S' ELSE 'B' END AS status
  FROM store_hour CROSS JOIN c)
SELECT restaurant_id, orders_per_service_hour, gap_tolerance, spare_threshold, count(*) AS hours,
       count(*) FILTER (WHERE status = 'P') AS pressure_hours, count(*) FILTER (WHERE status = 'S') AS spare_hours,
       count(*) FILTER (WHERE status = 'B') AS balanced_hours, count(*) FILTER (WHERE status = 'P') / count(*) AS pressure_share
FROM s GROUP BY ALL""",
        ),
        "restaurant_id:i, orders_per_service_hour:d, gap_tolerance:d, spare_threshold:d, hours:i, pressure_hours:i, spare_hours:i, "
        "balanced_hours:i, pressure_share:d",
    ),
)
def a42_capacity_thresholds(ctx):
    """Pressure, spare and balanced hours per site under several benchmarks and thresholds."""
    return feeds.capacity_thresholds(ctx.store_hour)


_SCOPE = ("AMERICA", "ASIA")


@query(
    "p01_scope_totals",
    typed(
        with_ctes(
            ["store_day_ledger", "restaurants"],
            f"""SELECT *, {RATE_SQL} FROM (SELECT {SUMS_SQL} FROM store_day_ledger
WHERE month = '2025-06' AND restaurant_id IN (SELECT restaurant_id FROM restaurants WHERE state IN {_SCOPE!r}))""",
        ),
        LEDGER_SPEC,
    ),
)
def p01_scope_totals(ctx):
    """Totals and rates of the sites of two regions in one month."""
    ids = ctx.restaurants.where(ctx.restaurants["state"].isin(*_SCOPE))
    return management.aggregate_scope(ctx.store_day, ids, "2025-06").select(*kpi.ADDITIVE, *RATE_COLS)
