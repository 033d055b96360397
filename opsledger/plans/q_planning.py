"""Planning queries: scheduled template hours, weekday profile, hourly staffing
plan and its daily roll-up (H02, H04, L01-L03, A38, F10)."""

from __future__ import annotations

from ..operators import planning
from ..sources.adapters import HISTORY_END
from . import q_analysis  # noqa: F401  (defines the forecast tables of the oracle)
from .oracle_base import cte, snap, typed, with_ctes
from .registry import query

A = planning.PlanningAssumptions()
CAPACITY = A.orders_per_service_hour * A.utilisation

cte(
    "scheduled_hour",
    ["labour"],
    f"""WITH s AS (
  SELECT restaurant_id, business_date, role, scheduled_start, scheduled_end,
         date_diff('second', scheduled_start, scheduled_end) / 3600.0 AS dur,
         date_diff('second', scheduled_start, scheduled_end) / 3600.0 - break_hours AS paid
  FROM labour),
a AS (
  SELECT restaurant_id, business_date, CAST(h AS INTEGER) AS hour, role,
         greatest(date_diff('second', greatest(scheduled_start, CAST(business_date AS TIMESTAMP) + to_hours(h)),
                            least(scheduled_end, CAST(business_date AS TIMESTAMP) + to_hours(h + 1))) / 3600.0, 0)
           * paid / dur AS alloc
  FROM s, range(11, 22) t(h))
SELECT restaurant_id, business_date, hour, {snap('sum(alloc)')} AS scheduled_paid_hours,
       {snap("sum(CASE WHEN role = 'Service' THEN alloc ELSE 0 END)")} AS scheduled_service_hours
FROM a GROUP BY restaurant_id, business_date, hour""",
)
cte(
    "planning_hour",
    ["store_hour", "scheduled_hour"],
    "SELECT h.*, s.scheduled_paid_hours, s.scheduled_service_hours FROM store_hour h "
    "JOIN scheduled_hour s USING (restaurant_id, business_date, hour)",
)


def _xavg(c: str) -> str:
    return f"CAST(sum(CAST(round({c} * 1000000.0) AS BIGINT)) AS DOUBLE) / 1000000.0 / count({c})"


cte(
    "weekday_profile",
    ["planning_hour", "store_day_ledger"],
    f"""WITH bk AS (
  SELECT restaurant_id, isodow(business_date) - 1 AS weekday,
         (CAST(sum(CAST(round(revenue * 100) AS BIGINT)) AS DOUBLE) / 100.0) / nullif(sum(transactions), 0) AS reference_atv
  FROM store_day_ledger
  WHERE business_date BETWEEN DATE '{HISTORY_END}' - 83 AND DATE '{HISTORY_END}' GROUP BY ALL),
p AS (
  SELECT restaurant_id, weekday, hour, sum(transactions) AS historical_orders,
         {_xavg('scheduled_service_hours')} AS scheduled_service_hours,
         {_xavg('scheduled_paid_hours')} AS scheduled_paid_hours,
         {_xavg('paid_hours')} AS historical_total_hours,
         {_xavg('service_hours')} AS historical_service_hours,
         count(DISTINCT business_date) AS observations
  FROM planning_hour
  WHERE business_date BETWEEN DATE '{HISTORY_END}' - 83 AND DATE '{HISTORY_END}' GROUP BY ALL)
SELECT p.*, historical_orders / nullif(sum(historical_orders) OVER (PARTITION BY restaurant_id, weekday), 0) AS hour_share,
       greatest(historical_total_hours - historical_service_hours, 0.0) AS support_hours, bk.reference_atv
FROM p LEFT JOIN bk USING (restaurant_id, weekday)""",
)

PROFILE_SPEC = (
    "restaurant_id:i, weekday:i, hour:i, historical_orders:i, scheduled_service_hours:d, scheduled_paid_hours:d, "
    "historical_total_hours:d, historical_service_hours:d, observations:i, hour_share:d, support_hours:d, "
    "reference_atv:d"
)


@query("h02_scheduled_hours", typed(with_ctes(["scheduled_hour"], "SELECT * FROM scheduled_hour"),
                                    "restaurant_id:i, business_date:t, hour:i, scheduled_paid_hours:d, "
                                    "scheduled_service_hours:d"))
def h02_scheduled_hours(ctx):
    """Scheduled shifts spread over trading hours, conservation checked."""
    return ctx.scheduled_hour


@query(
    "h04_planning_hours",
    typed(
        with_ctes(
            ["planning_hour"],
            "SELECT restaurant_id, business_date, hour, transactions, paid_hours, service_hours, "
            "scheduled_paid_hours, scheduled_service_hours, staffing_status FROM planning_hour",
        ),
        "restaurant_id:i, business_date:t, hour:i, transactions:i, paid_hours:d, service_hours:d, "
        "scheduled_paid_hours:d, scheduled_service_hours:d, staffing_status:s",
    ),
)
def h04_planning_hours(ctx):
    """Store-hour mart with the scheduled template attached one-to-one."""
    return ctx.planning_hour.select(
        "restaurant_id", "business_date", "hour", "transactions", "paid_hours", "service_hours",
        "scheduled_paid_hours", "scheduled_service_hours", "staffing_status",
    )


@query("l01_weekday_profile", typed(with_ctes(["weekday_profile"], "SELECT * FROM weekday_profile"), PROFILE_SPEC))
def l01_weekday_profile(ctx):
    """84-day weekday x hour profile before the origin: orders, hour share, template and actual hours, ATV."""
    basket, prof = planning.weekday_profile(ctx.store_day, ctx.planning_hour, HISTORY_END)
    return prof.join(basket, ["restaurant_id", "weekday"], "left")


_orders = "{src} / p.reference_atv * p.hour_share * {dm}::DOUBLE"


def _staff(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NOT NULL THEN greatest({float(A.minimum_service_staff)}::DOUBLE, "
        f"CAST(ceil({c} / {CAPACITY!r}::DOUBLE) AS DOUBLE)) END"
    )


cte(
    "hourly_plan",
    ["forecast_daily", "weekday_profile"],
    f"""WITH f AS (
  SELECT f.*, isodow(f.business_date) - 1 AS weekday, CAST(h AS INTEGER) AS hour
  FROM forecast_daily f, range(11, 22) t(h)),
o AS (
  SELECT f.restaurant_id, f.business_date, f.hour, f.weekday, f.origin_date, f.forecast_revenue, f.lower_80, f.upper_80,
         p.historical_orders, p.observations, p.hour_share, p.reference_atv,
         p.scheduled_service_hours * {A.schedule_multiplier}::DOUBLE AS scheduled_service_hours,
         p.scheduled_paid_hours * {A.schedule_multiplier}::DOUBLE AS scheduled_paid_hours,
         p.historical_total_hours, p.historical_service_hours, p.support_hours,
         {_orders.format(src='f.forecast_revenue', dm=A.demand_multiplier)} AS forecast_orders,
         {_orders.format(src='f.lower_80', dm=A.demand_multiplier)} AS orders_lower,
         {_orders.format(src='f.upper_80', dm=A.demand_multiplier)} AS orders_upper,
         p.reference_atv IS NOT NULL AND p.hour_share IS NOT NULL AND p.observations IS NOT NULL AS history_complete
  FROM f LEFT JOIN weekday_profile p USING (restaurant_id, weekday, hour)),
s AS (
  SELECT *, {_staff('forecast_orders')} AS suggested_service_hours, {_staff('orders_lower')} AS service_hours_lower,
         {_staff('orders_upper')} AS service_hours_upper
  FROM o),
g AS (
  SELECT *, suggested_service_hours + support_hours AS suggested_paid_hours,
         suggested_service_hours - scheduled_service_hours AS service_gap_hours
  FROM s)
SELECT *, CASE WHEN service_gap_hours > 0.5 THEN '{planning.UNDER}' WHEN service_gap_hours < -0.5 THEN '{planning.SPARE}'
               ELSE '{planning.WITHIN}' END AS planning_status,
       suggested_paid_hours * {A.loaded_hourly_wage}::DOUBLE AS suggested_labour_cost,
       scheduled_paid_hours * {A.loaded_hourly_wage}::DOUBLE AS template_labour_cost,
       suggested_paid_hours * {A.loaded_hourly_wage}::DOUBLE - scheduled_paid_hours * {A.loaded_hourly_wage}::DOUBLE
         AS budget_difference,
       '{planning.SCHEDULE_BASIS}' AS schedule_basis,
       {A.orders_per_service_hour}::DOUBLE AS orders_per_service_hour, {A.utilisation}::DOUBLE AS utilisation,
       {A.minimum_service_staff} AS minimum_service_staff, {A.schedule_multiplier}::DOUBLE AS schedule_multiplier,
       {A.demand_multiplier}::DOUBLE AS demand_multiplier, {A.loaded_hourly_wage}::DOUBLE AS loaded_hourly_wage
FROM g""",
)

_TYPES = {
    "restaurant_id": "i", "business_date": "t", "hour": "i", "weekday": "i", "origin_date": "t",
    "historical_orders": "i", "observations": "i", "planning_status": "s", "schedule_basis": "s",
    "history_complete": "b", "minimum_service_staff": "i",
}
PLAN_SPEC = ", ".join(f"{c}:{_TYPES.get(c, 'd')}" for c in planning.PLAN_COLUMNS)


def _plan(ctx):
    return planning.hourly_plan(ctx.store_day, ctx.planning_hour, ctx.forecast_daily)


@query("l02_hourly_plan", typed(with_ctes(["hourly_plan"], "SELECT * FROM hourly_plan"), PLAN_SPEC))
def l02_hourly_plan(ctx):
    """Hourly orders, staffing, gap status and labour budget per forecast day."""
    return _plan(ctx).select(*planning.PLAN_COLUMNS)


@query(
    "a38_daily_labour_plan",
    typed(
        with_ctes(
            ["hourly_plan", "restaurants"],
            """SELECT p.restaurant_id, p.business_date, coalesce(sum(forecast_orders), 0) AS orders,
       coalesce(sum(suggested_paid_hours), 0) AS suggested_hours, coalesce(sum(scheduled_paid_hours), 0) AS template_hours,
       coalesce(sum(suggested_labour_cost), 0) AS suggested_cost, coalesce(sum(budget_difference), 0) AS budget_difference,
       r.restaurant_name AS restaurant
FROM hourly_plan p JOIN restaurants r USING (restaurant_id) GROUP BY p.restaurant_id, p.business_date, r.restaurant_name""",
        ),
        "restaurant_id:i, business_date:t, orders:d, suggested_hours:d, template_hours:d, suggested_cost:d, "
        "budget_difference:d, restaurant:s",
    ),
)
def a38_daily_labour_plan(ctx):
    """Daily roll-up of the hourly plan."""
    return planning.daily_labour_plan(_plan(ctx), ctx.restaurants)


@query(
    "f10_forecast_daily",
    typed(
        with_ctes(["forecast_daily"], "SELECT * FROM forecast_daily"),
        "restaurant_id:i, business_date:t, origin_date:t, forecast_revenue:d, lower_80:d, upper_80:d",
    ),
)
def f10_forecast_daily(ctx):
    """Final refit from the last history date with empirical 80 % bands."""
    return ctx.forecast_daily.select(
        "restaurant_id", "business_date", "origin_date", "forecast_revenue", "lower_80", "upper_80"
    )
