"""Dictionary and lineage of the marts, carried by the stored files themselves.

Each column of a stored mart has a comment in its schema, and each key column names the mart's
grain and what the mart is made from. Parquet keeps this field metadata, so a reader of the files
gets it back without this library; the dictionary and the catalog are read from there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dataset:
    keys: tuple[str, ...]
    grain: str
    lineage: tuple[str, ...]


def _d(keys: str, grain: str, lineage: str) -> Dataset:
    return Dataset(tuple(keys.split()), grain, tuple(lineage.split()))


DATASETS: dict[str, Dataset] = {
    "store_dimension": _d("restaurant_id", "one row per site", "restaurants"),
    "orders": _d("order_id", "one row per clean order", "transactions"),
    "product_month": _d("restaurant_id month product_id channel", "one row per site, month, product and channel", "transactions products"),
    "waste_detail": _d("restaurant_id business_date product_id reason", "one row per site, day, product and reason", "waste products"),
    "store_day": _d(
        "restaurant_id business_date", "one row per site and calendar day, days without sales included",
        "orders labour waste customer_feedback delivery operating_costs promotions calendar store_dimension",
    ),
    "store_hour": _d("restaurant_id business_date hour", "one row per site, day and trading hour", "store_day orders labour"),
    "store_month_kpis": _d("restaurant_id month", "one row per site and month", "store_day targets store_dimension"),
    "customer_segment_summary": _d("restaurant_id segment", "one row per first site and customer segment", "orders loyalty"),
    "customer_cohorts": _d("restaurant_id cohort_month", "one row per first site and month of the first visit", "orders"),
    "campaign_days": _d("promotion_id campaign_day", "one row per campaign and day of it that has controls", "store_day promotions store_dimension"),
    "promotion_effectiveness": _d("promotion_id", "one row per campaign", "campaign_days promotions"),
    "forecast_backtests": _d("restaurant_id business_date model origin_date", "one row per site, day, model and origin", "store_day calendar"),
    "forecast_daily": _d("restaurant_id business_date", "one row per site and day after the last origin", "store_day forecast_backtests calendar"),
    "labour_plan": _d("restaurant_id business_date hour", "one row per site, forecast day and trading hour", "forecast_daily store_day store_hour labour"),
    "weekly_performance": _d("restaurant_id window_end", "one row per site and week that ends the history", "store_day targets"),
}

_TEXT = """
actual_revenue: Net sales that the day really had
allocated_revenue_target: Monthly targets spread over their days, summed over the week
area: Area of the site
average_transaction_value: Net sales per order
baseline_orders: Orders expected without the campaign
baseline_revenue: Net sales expected without the campaign
baseline_variable_cost: Ingredient, waste and commission cost expected without the campaign
before_revenue: Net sales of the same place in the comparison window
budget_difference: Suggested less template labour cost
business_date: Local calendar day of trading
campaign_cost: Campaign spend, evenly spread over the campaign's days where the grain is a day
campaign_day: Place of the day in its campaign, from 0
campaign_name: Name the campaign ran under
category: Product category of the approved taxonomy
channel: Dine-in, takeaway or delivery
cohort_month: Month of a customer's first visit
commission_cost: Commission of delivery partners
comparison_start: First day of the window before the campaign
close_hour: Hour from which the site is closed
complete: Whether both weeks have all seven days
contribution_before_campaign: Extra sales less extra variable cost and labour, before the spend
contribution_high95: Upper end of the resampled 95 percent range of the net contribution
contribution_low95: Lower end of the resampled 95 percent range of the net contribution
control_change: Control mean during over control mean before
control_restaurant_ids: Sites of the peer group without a campaign in the window, as a JSON list
control_stores: Number of control sites
customer_id: Customer of an identified order
customers: Customers of the segment
capacity_gap_orders: Orders above the capacity of the service hours
daypart: Lunch before 16 hours, else dinner
deliveries: Delivered orders
demand_multiplier: Planning lever on forecast orders
discount_amount: Discounts off the list price
discount_rate: Discount the campaign offered
discounts: Discounts given
eligible_customers: Customers seen long enough to judge a return
end_date: Last day of the campaign
estimate_status: Whether the estimate exists, else why not
evaluation_period: Validation or holdout
fold: Number of the validation fold, 0 for the holdout
forecast_orders: Orders expected in the hour
forecast_revenue: Forecast net sales of the day
gross_contribution: Net sales less ingredient cost
gross_margin_pct: Gross contribution over net sales
historical_orders: Orders of the weekday and hour in the profile window
historical_service_hours: Mean service hours of the weekday and hour
historical_total_hours: Mean paid hours of the weekday and hour
history_complete: Whether the profile has a basket and a share for the hour
holiday_name: Name of the public holiday
horizon_day: Days after the origin
hour: Clock hour
hour_share: Share of the weekday's orders that falls in the hour
identified_customers: Customers first seen in the month
identified_order_share: Share of orders with a known customer
identified_orders: Orders with a known customer
incremental_contribution: Contribution after the campaign spend
incremental_labour_cost: Labour cost during less labour cost before
incremental_orders: Observed less expected orders
incremental_revenue: Observed less expected net sales
incremental_variable_cost: Observed less expected variable cost
index_complete: Whether all five scores exist
ingredient_cost: Cost of the ingredients sold
is_public_holiday: 1 on a public holiday
is_weekend: 1 on Saturday and Sunday
labour_cost: Cost of paid hours
labour_cost_pct: Labour cost over net sales
labour_pct_target: Target of labour cost over net sales
late_deliveries: Deliveries later than promised
late_delivery_pct: Late deliveries over deliveries
list_revenue: Sales at list price
loaded_hourly_wage: Planning wage per paid hour
location_type: Peer group of the site
lower_80: Lower end of the empirical 80 percent band, not below 0
menu_price_ex_gst: List price of the product before tax
minimum_service_staff: Least people on service in an hour
model: Name of the model
month: Calendar month as text
monthly_overheads: Overheads of the whole month
observations: Days of the weekday in the profile window
observed_orders: Orders during the campaign
observed_revenue: Net sales during the campaign
observed_variable_cost: Ingredient, waste and commission cost during the campaign
open_hour: Hour from which the site is open
operating_margin_pct: Operating profit over net sales
operating_margin_target: Target of operating profit over net sales
operating_profit: Net sales less the six costs
order_id: Order
orders_lower: Orders at the lower end of the band
orders_per_service_hour: Orders that one service hour handles
orders_upper: Orders at the upper end of the band
orders_with_product: Orders that hold the product
origin_date: Last day the forecast may know
overhead_cost: Monthly overheads, evenly spread over the month's days where the grain is a day
paid_hours: Paid working hours
peer_revenue_before: Control mean of net sales before
peer_revenue_during: Control mean of net sales on the day
performance_index: Weighted mean of the five scores, 0 to 100
planning_status: Whether the template has too few, enough or too many hours
product_id: Product
product_name: Name of the product
profit_change: Operating profit less that of the week before
promotion_id: Campaign
promotion_roi: Net contribution over spend
reason: Why the product was wasted
reference_atv: Net sales per order of the weekday in the profile window
repeat_customer_rate: Returning over eligible customers
repeat_customers: Eligible customers who came back within 90 days
restaurant_id: Site
restaurant_name: Name of the site in the site master
revenue: Net sales after discounts, before tax
revenue_change: Net sales less those of the week before
revenue_growth: Change of net sales over the week before
revenue_growth_mom: Change of net sales over the month before
revenue_growth_yoy: Change of net sales over the same month a year before
revenue_target: Target of net sales
sales_per_labour_hour: Net sales per paid hour
satisfaction_score: Mean survey score of answered surveys
satisfaction_target: Target of the mean survey score
schedule_basis: What the template hours are taken from
schedule_multiplier: Planning lever on template hours
scheduled_paid_hours: Paid hours of the template
scheduled_service_hours: Service hours of the template
school_holiday_proxy: 1 in weeks that are usually school holidays
score_labour: Labour share against target, 0 to 100
score_margin: Operating margin against target, 0 to 100
score_revenue: Net sales against target, 0 to 100
score_satisfaction: Satisfaction against target, 0 to 100
score_sum: Sum of survey scores
score_waste: Waste share against target, 0 to 100
season: Season of the southern year
seats: Seats of the site
segment: Customer segment by recency and visits
service_capacity_orders: Orders that the service hours can handle
service_gap_hours: Suggested less template service hours
service_hours: Paid hours of service roles
service_hours_lower: Service hours for the lower end of the band
service_hours_upper: Service hours for the upper end of the band
spend: Net sales to the segment's customers
staffing_status: Pressure, balanced or spare capacity
standard_ingredient_cost: Usual ingredient cost of one unit
start_date: First day of the campaign
state: Region of the site
suggested_labour_cost: Suggested paid hours at the planning wage
suggested_paid_hours: Suggested service hours and support hours
suggested_service_hours: Whole people needed for the forecast orders
support_hours: Paid hours that are not service
survey_responses: Surveys answered
target_achievement_pct: Net sales over their target
target_gap: Net sales less the allocated target
template_labour_cost: Template paid hours at the planning wage
timestamp_local: Local time of the order
transactions: Orders
transactions_per_labour_hour: Orders per paid hour
units: Units sold
upper_80: Upper end of the empirical 80 percent band
utilisation: Share of service hours planned for orders
visits: Days with a visit, summed over customers
waste_cost: Cost of wasted units
waste_pct: Waste cost over ingredient and waste cost
waste_pct_target: Target of the waste share
waste_units: Units wasted
weekday: Day of the week, Monday 0
window_end: Last day of the week
window_start: First day of the week
"""
DEFINITIONS: dict[str, str] = dict(line.split(": ", 1) for line in _TEXT.strip().splitlines())


def definition(field: str) -> str:
    """What a field means; ``prior_`` fields are their field in the week before."""
    return DEFINITIONS[field] if field in DEFINITIONS else f"{DEFINITIONS[field.removeprefix('prior_')]}, in the week before"


def described(name: str, df: DataFrame) -> DataFrame:
    """The mart with its dictionary and lineage in the schema; a field without definition is an error."""
    about = DATASETS[name]

    def metadata(field: str) -> dict:
        own = {"comment": definition(field)}
        if field in about.keys:
            own |= {"key": about.keys.index(field) + 1, "grain": about.grain, "lineage": list(about.lineage)}
        return own

    return df.select(*(F.col(c).alias(c, metadata=metadata(c)) for c in df.columns))


def schema_dictionary(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, field, definition, is_pk) as the stored marts' schemas tell it."""
    rows = [(t, f.name, f.metadata.get("comment"), "key" in f.metadata) for t, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "tbl string, field string, definition string, is_pk boolean")


def grain_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """(dataset, grain_keys, grain, lineage, rows, repeated_keys) of stored marts.

    Keys, grain and lineage come from the schema; the rows prove them, in one grouping per mart."""
    parts = []
    for name, df in tables.items():
        keys = sorted((f for f in df.schema.fields if "key" in f.metadata), key=lambda f: f.metadata["key"])
        about = keys[0].metadata
        counted = df.groupBy(*(f.name for f in keys)).agg(F.count(F.lit(1)).alias("n"))
        counted = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_keys"))
        parts.append(
            counted.select(
                F.lit(name).alias("dataset"), F.lit(", ".join(f.name for f in keys)).alias("grain_keys"), F.lit(about["grain"]).alias("grain"),
                F.lit(", ".join(about["lineage"])).alias("lineage"), "rows", "repeated_keys",
            )
        )
    return reduce(DataFrame.unionByName, parts)
