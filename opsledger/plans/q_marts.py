"""Mart queries: calendar, orders, product mix, daily ledger, hourly capacity, KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import kpi, marts
from .oracle_base import cte, msum, snap, typed, with_ctes
from .registry import query

DAY_COLS = (
    "restaurant_id restaurant_name state location_type area business_date holiday_name is_public_holiday "
    "weekday is_weekend season school_holiday_proxy month revenue ingredient_cost transactions discounts "
    "identified_orders labour_cost paid_hours service_hours waste_cost score_sum survey_responses "
    "commission_cost deliveries late_deliveries monthly_overheads overhead_cost promotion_id campaign_cost "
    "operating_profit satisfaction_score"
).split()
DAY_SPEC = (
    "restaurant_id:i, restaurant_name:s, state:s, location_type:s, area:s, business_date:t, holiday_name:s, "
    "is_public_holiday:i, weekday:i, is_weekend:i, season:s, school_holiday_proxy:i, month:s, revenue:d, "
    "ingredient_cost:d, transactions:i, discounts:d, identified_orders:i, labour_cost:d, paid_hours:d, "
    "service_hours:d, waste_cost:d, score_sum:d, survey_responses:i, commission_cost:d, deliveries:i, "
    "late_deliveries:i, monthly_overheads:d, overhead_cost:d, promotion_id:s, campaign_cost:d, "
    "operating_profit:d, satisfaction_score:d"
)


@query(
    "p13_calendar",
    typed(
        with_ctes(["calendar"], "SELECT * FROM calendar"),
        "business_date:t, state:s, holiday_name:s, is_public_holiday:i, weekday:i, is_weekend:i, month:i, "
        "season:s, school_holiday_proxy:i",
    ),
)
def p13_calendar(ctx):
    """Date x state calendar dimension."""
    return ctx.calendar


@query(
    "a01_orders",
    typed(
        with_ctes(["orders_mart"], "SELECT * FROM orders_mart"),
        "order_id:i, restaurant_id:i, business_date:t, timestamp_local:x, hour:i, daypart:s, channel:s, "
        "customer_id:i, promotion_id:s, revenue:d, ingredient_cost:d, discount_amount:d, units:i",
    ),
)
def a01_orders(ctx):
    """Order roll-up from lines."""
    return ctx.orders


@query(
    "a02_product_month",
    typed(
        with_ctes(
            ["transactions", "products"],
            f"""SELECT t.*, p.product_name, p.category, p.menu_price_ex_gst, p.standard_ingredient_cost,
       t.revenue - t.ingredient_cost AS gross_contribution
FROM (SELECT restaurant_id, month, product_id, channel, {msum('net_revenue')} AS revenue,
             {msum('ingredient_cost')} AS ingredient_cost, {msum('list_revenue')} AS list_revenue,
             {msum('discount_amount')} AS discount_amount, sum(quantity) AS units,
             count(DISTINCT order_id) AS orders_with_product
      FROM transactions GROUP BY ALL) t JOIN products p ON t.product_id = p.product_id""",
        ),
        "restaurant_id:i, month:s, product_id:i, channel:s, revenue:d, ingredient_cost:d, list_revenue:d, "
        "discount_amount:d, units:i, orders_with_product:i, product_name:s, category:s, menu_price_ex_gst:d, "
        "standard_ingredient_cost:d, gross_contribution:d",
    ),
)
def a02_product_month(ctx):
    """Product x site x month x channel mix."""
    return marts.product_month(ctx.transactions, ctx.products)


@query(
    "a05_waste_detail",
    typed(
        with_ctes(
            ["waste", "products"],
            f"""SELECT w.*, p.product_name, p.category
FROM (SELECT restaurant_id, business_date, product_id, reason, sum(waste_units) AS waste_units,
             {msum('waste_cost')} AS waste_cost FROM waste GROUP BY ALL) w
JOIN products p ON w.product_id = p.product_id""",
        ),
        "restaurant_id:i, business_date:t, product_id:i, reason:s, waste_units:i, waste_cost:d, "
        "product_name:s, category:s",
    ),
)
def a05_waste_detail(ctx):
    """Waste by site, day, product and reason."""
    return marts.waste_detail(ctx.waste, ctx.products)


@query("a10_store_day", typed(with_ctes(["store_day_ledger"], "SELECT * FROM store_day_ledger"), DAY_SPEC))
def a10_store_day(ctx):
    """Daily profit ledger on the complete site x calendar spine."""
    return ctx.store_day.select(*DAY_COLS)


HOUR_SPEC = (
    "restaurant_id:i, restaurant_name:s, state:s, area:s, business_date:t, hour:i, transactions:i, revenue:d, "
    "paid_hours:d, service_hours:d, labour_cost:d, service_capacity_orders:d, capacity_gap_orders:d, "
    "staffing_status:s, weekday:i, daypart:s"
)
HOUR_SQL = f"""WITH grid AS (
  SELECT d.restaurant_id, d.restaurant_name, d.state, d.area, d.business_date, h AS hour
  FROM store_day d, range(11, 22) t(h)),
alloc AS (
  SELECT l.restaurant_id, l.business_date, h AS hour, l.role, l.hourly_cost,
         greatest(date_diff('second', greatest(l.actual_start, CAST(l.business_date AS TIMESTAMP) + to_hours(h)),
                            least(l.actual_end, CAST(l.business_date AS TIMESTAMP) + to_hours(h + 1))) / 3600.0, 0)
           * l.paid_hours / (date_diff('second', l.actual_start, l.actual_end) / 3600.0) AS paid
  FROM labour l, range(11, 22) t(h)),
cap AS (
  SELECT restaurant_id, business_date, hour, {snap('sum(paid)')} AS paid_hours,
         {snap("sum(CASE WHEN role = 'Service' THEN paid ELSE 0 END)")} AS service_hours,
         {snap('sum(paid * hourly_cost)')} AS labour_cost
  FROM alloc GROUP BY ALL),
sales AS (
  SELECT restaurant_id, business_date, hour, count(*) AS transactions, {msum('revenue')} AS revenue
  FROM orders_mart GROUP BY ALL)
SELECT g.*, coalesce(s.transactions, 0) AS transactions, coalesce(s.revenue, 0) AS revenue,
       c.paid_hours, c.service_hours, c.labour_cost,
       c.service_hours * 6 AS service_capacity_orders,
       coalesce(s.transactions, 0) - c.service_hours * 6 AS capacity_gap_orders,
       CASE WHEN coalesce(s.transactions, 0) - c.service_hours * 6 > 2 + 1e-9 THEN 'Pressure'
            WHEN coalesce(s.transactions, 0) < c.service_hours * 6 * 0.45 - 1e-9 THEN 'Spare capacity'
            ELSE 'Balanced' END AS staffing_status,
       isodow(g.business_date) - 1 AS weekday,
       CASE WHEN g.hour < 16 THEN 'Lunch' ELSE 'Dinner' END AS daypart
FROM grid g
LEFT JOIN sales s USING (restaurant_id, business_date, hour)
LEFT JOIN cap c USING (restaurant_id, business_date, hour)"""


@query("a11_store_hour", typed(with_ctes(["store_day", "orders_mart", "labour"], HOUR_SQL), HOUR_SPEC))
def a11_store_hour(ctx):
    """Hourly demand vs allocated service capacity and staffing status."""
    return ctx.store_hour


KPI_COLS = (
    "restaurant_id month restaurant_name state location_type area " + " ".join(kpi.ADDITIVE) + " "
    "gross_contribution average_transaction_value gross_margin_pct operating_margin_pct labour_cost_pct "
    "sales_per_labour_hour transactions_per_labour_hour waste_pct satisfaction_score identified_order_share "
    "late_delivery_pct revenue_target operating_margin_target labour_pct_target waste_pct_target "
    "satisfaction_target revenue_growth_mom revenue_growth_yoy target_achievement_pct score_revenue "
    "score_margin score_labour score_waste score_satisfaction index_complete performance_index"
).split()

_INT_ADD = {"transactions", "identified_orders", "survey_responses", "deliveries", "late_deliveries"}
KPI_SPEC = ", ".join(
    f"{c}:{'s' if c in ('month', 'restaurant_name', 'state', 'location_type', 'area') else 'i' if c in _INT_ADD or c == 'restaurant_id' else 'b' if c == 'index_complete' else 'd'}"
    for c in KPI_COLS
)
_SUMS = ", ".join(f"{msum(c) if c in kpi.MONEY else f'sum({c})'} AS {c}" for c in kpi.ADDITIVE)
KPI_SQL = f"""WITH m AS (
  SELECT restaurant_id, month, {_SUMS} FROM store_day_ledger GROUP BY restaurant_id, month),
r AS (
  SELECT m.*, revenue - ingredient_cost AS gross_contribution,
         revenue / nullif(transactions, 0) AS average_transaction_value,
         (revenue - ingredient_cost) / nullif(revenue, 0) AS gross_margin_pct,
         operating_profit / nullif(revenue, 0) AS operating_margin_pct,
         labour_cost / nullif(revenue, 0) AS labour_cost_pct,
         revenue / nullif(paid_hours, 0) AS sales_per_labour_hour,
         transactions / nullif(paid_hours, 0) AS transactions_per_labour_hour,
         waste_cost / nullif(ingredient_cost + waste_cost, 0) AS waste_pct,
         score_sum / nullif(survey_responses, 0) AS satisfaction_score,
         identified_orders / nullif(transactions, 0) AS identified_order_share,
         late_deliveries / nullif(deliveries, 0) AS late_delivery_pct
  FROM m),
j AS (
  SELECT r.*, s.restaurant_name, s.state, s.location_type, s.area, t.revenue_target, t.operating_margin_target,
         t.labour_pct_target, t.waste_pct_target, t.satisfaction_target,
         (revenue - lag(revenue, 1) OVER w) / nullif(lag(revenue, 1) OVER w, 0) AS revenue_growth_mom,
         (revenue - lag(revenue, 12) OVER w) / nullif(lag(revenue, 12) OVER w, 0) AS revenue_growth_yoy,
         revenue / nullif(t.revenue_target, 0) AS target_achievement_pct
  FROM r JOIN targets t USING (restaurant_id, month) JOIN restaurants s USING (restaurant_id)
  WINDOW w AS (PARTITION BY restaurant_id ORDER BY month)),
sc AS (
  SELECT j.*,
    CASE WHEN target_achievement_pct IS NOT NULL THEN least(greatest(100 * target_achievement_pct, 0), 100) END AS score_revenue,
    CASE WHEN operating_margin_pct / nullif(operating_margin_target, 0) IS NOT NULL
         THEN least(greatest(100 * operating_margin_pct / nullif(operating_margin_target, 0), 0), 100) END AS score_margin,
    CASE WHEN labour_pct_target / nullif(labour_cost_pct, 0) IS NOT NULL
         THEN least(greatest(100 * labour_pct_target / nullif(labour_cost_pct, 0), 0), 100) END AS score_labour,
    CASE WHEN waste_pct = 0 THEN 100.0
         WHEN waste_pct_target / nullif(waste_pct, 0) IS NOT NULL
         THEN least(greatest(100 * waste_pct_target / nullif(waste_pct, 0), 0), 100) END AS score_waste,
    CASE WHEN satisfaction_score / nullif(satisfaction_target, 0) IS NOT NULL
         THEN least(greatest(100 * satisfaction_score / nullif(satisfaction_target, 0), 0), 100) END AS score_satisfaction
  FROM j)
SELECT *, (score_revenue IS NOT NULL AND score_margin IS NOT NULL AND score_labour IS NOT NULL
           AND score_waste IS NOT NULL AND score_satisfaction IS NOT NULL) AS index_complete,
       0.25 * score_revenue + 0.25 * score_margin + 0.20 * score_labour + 0.15 * score_waste
       + 0.15 * score_satisfaction AS performance_index
FROM sc"""


@query(
    "a12_store_month_kpis",
    typed(with_ctes(["store_day_ledger", "targets", "restaurants"], KPI_SQL), KPI_SPEC),
)
def a12_store_month_kpis(ctx):
    """Monthly KPIs, targets, MoM/YoY growth and Performance Index."""
    return ctx.store_month_kpis.select(*KPI_COLS)


cte("store_hour", ["store_day", "orders_mart", "labour"], HOUR_SQL)
