"""Grain-explicit marts: facts are aggregated to the target grain, then joined.

* ``orders``          order_id                                  (A01)
* ``product_month``   restaurant_id, month, product_id, channel (A02)
* ``store_day``       restaurant_id, business_date              (A03-A10, J02)
* ``store_hour``      restaurant_id, business_date, hour        (A11, H01, H03)
* ``waste_detail``    restaurant_id, business_date, product_id, reason (A05)

All store-keyed roll-ups are aggregated to (restaurant_id, business_date) before
they meet the spine, so the joins only ever see one row per key and side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import (
    broadcast_if_small,
    daypart,
    days_in_month,
    first_match,
    money_sum,
    month_text,
    null_sum,
    ratio,
    snap,
    weekday,
    unique_on,
)

ADDITIVE_DAY = [
    "revenue",
    "ingredient_cost",
    "transactions",
    "discounts",
    "identified_orders",
    "labour_cost",
    "paid_hours",
    "service_hours",
    "waste_cost",
    "score_sum",
    "survey_responses",
    "commission_cost",
    "deliveries",
    "late_deliveries",
]

# Six cost lines of the operating ledger, in ledger order.
COSTS = [
    "ingredient_cost",
    "waste_cost",
    "labour_cost",
    "commission_cost",
    "overhead_cost",
    "campaign_cost",
]

TRADING_HOURS = (11, 21)


# ---------------------------------------------------------------- P13
def calendar(states: DataFrame, start: str, end: str, holidays: DataFrame | None = None) -> DataFrame:
    """Date x state calendar with weekday (Mon = 0), weekend, season, holidays.

    ``holidays`` (business_date, holiday_name) is an input dimension; by default
    1 January and 25 December are public holidays.
    """
    d = states.select(
        "state",
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(
            "business_date"
        ),
    )
    if holidays is None:
        name = (
            F.when((F.month("business_date") == 1) & (F.dayofmonth("business_date") == 1), "New Year's Day")
            .when((F.month("business_date") == 12) & (F.dayofmonth("business_date") == 25), "Christmas Day")
        )
        d = d.withColumn("holiday_name", name)
    else:
        d = d.join(broadcast_if_small(holidays), "business_date", "left")
    m = F.month("business_date")
    return d.select(
        "business_date",
        "state",
        "holiday_name",
        F.col("holiday_name").isNotNull().cast("int").alias("is_public_holiday"),
        weekday("business_date").alias("weekday"),
        (weekday("business_date") >= 5).cast("int").alias("is_weekend"),
        m.alias("month"),
        first_match(
            [(m.isin(12, 1, 2), "Summer"), (m.isin(3, 4, 5), "Autumn"), (m.isin(6, 7, 8), "Winter")],
            "Spring",
        ).alias("season"),
        (m.isin(1, 7, 12) | (m.isin(4, 10) & (F.dayofmonth("business_date") <= 14)))
        .cast("int")
        .alias("school_holiday_proxy"),
    )


# ---------------------------------------------------------------- A01
def orders(tx: DataFrame) -> DataFrame:
    """Order roll-up: attributes are constant per order (checked by Q16)."""
    return tx.groupBy("order_id").agg(
        F.min("restaurant_id").alias("restaurant_id"),
        F.min("business_date").alias("business_date"),
        F.min("timestamp_local").alias("timestamp_local"),
        F.min("hour").alias("hour"),
        F.min("daypart").alias("daypart"),
        F.min("channel").alias("channel"),
        F.min("customer_id").alias("customer_id"),
        F.min("promotion_id").alias("promotion_id"),
        money_sum("net_revenue").alias("revenue"),
        money_sum("ingredient_cost").alias("ingredient_cost"),
        money_sum("discount_amount").alias("discount_amount"),
        F.sum("quantity").alias("units"),
    )


# ---------------------------------------------------------------- A02
def product_month(tx: DataFrame, products: DataFrame) -> DataFrame:
    """Product mix per site, month and channel; order counts are not additive."""
    agg = tx.groupBy("restaurant_id", "month", "product_id", "channel").agg(
        money_sum("net_revenue").alias("revenue"),
        money_sum("ingredient_cost").alias("ingredient_cost"),
        money_sum("list_revenue").alias("list_revenue"),
        money_sum("discount_amount").alias("discount_amount"),
        F.sum("quantity").alias("units"),
        F.countDistinct("order_id").alias("orders_with_product"),
    )
    out = agg.join(unique_on(products, "product_id"), "product_id")
    return out.withColumn("gross_contribution", F.col("revenue") - F.col("ingredient_cost"))


# ---------------------------------------------------------------- A03..A09
def sales_day(orders_mart: DataFrame) -> DataFrame:
    return orders_mart.groupBy("restaurant_id", "business_date").agg(
        money_sum("revenue").alias("revenue"),
        money_sum("ingredient_cost").alias("ingredient_cost"),
        F.count(F.lit(1)).alias("transactions"),
        money_sum("discount_amount").alias("discounts"),
        F.count("customer_id").alias("identified_orders"),
    )


def roster_day(labour: DataFrame) -> DataFrame:
    """Paid hours and cost per day, Service hours in the same pass."""
    return labour.groupBy("restaurant_id", "business_date").agg(
        money_sum("labour_cost").alias("labour_cost"),
        F.sum("paid_hours").alias("paid_hours"),
        F.sum(F.when(F.col("role") == "Service", F.col("paid_hours"))).alias("service_hours"),
    )


def waste_day(waste: DataFrame) -> DataFrame:
    return waste.groupBy("restaurant_id", "business_date").agg(money_sum("waste_cost").alias("waste_cost"))


def waste_detail(waste: DataFrame, products: DataFrame) -> DataFrame:
    agg = waste.groupBy("restaurant_id", "business_date", "product_id", "reason").agg(
        F.sum("waste_units").alias("waste_units"), money_sum("waste_cost").alias("waste_cost")
    )
    return agg.join(unique_on(products.select("product_id", "product_name", "category"), "product_id"), "product_id")


def feedback_day(feedback: DataFrame) -> DataFrame:
    """Score sum and answered count; unanswered surveys stay out of both."""
    return feedback.groupBy("restaurant_id", "business_date").agg(
        F.sum("overall_score").alias("score_sum"), F.count("overall_score").alias("survey_responses")
    )


def delivery_day(delivery: DataFrame, orders_mart: DataFrame) -> DataFrame:
    """Commission, deliveries, late deliveries per day.

    The delivery date comes from its order (inner join: unmatched deliveries
    have no business date)."""
    d = delivery.join(orders_mart.select("order_id", "business_date"), "order_id")
    return d.groupBy("restaurant_id", "business_date").agg(
        money_sum("commission_cost").alias("commission_cost"),
        F.count("order_id").alias("deliveries"),
        F.count_if(F.col("actual_minutes") > F.col("promised_minutes")).alias("late_deliveries"),
    )


def monthly_overheads(costs: DataFrame) -> DataFrame:
    return costs.groupBy("restaurant_id", "month").agg(F.sum("amount").alias("monthly_overheads"))


def campaign_days(promotions: DataFrame) -> DataFrame:
    """Interval join as explode-to-day (J09/A09): cost spread over active days.

    Where campaigns of one site overlap, the later-starting one wins.
    """
    days = promotions.select(
        "restaurant_id",
        "promotion_id",
        "start_date",
        F.explode(F.sequence("start_date", "end_date")).alias("business_date"),
        (F.col("campaign_cost") / (F.datediff("end_date", "start_date") + 1)).alias("campaign_cost"),
    )
    return days.groupBy("restaurant_id", "business_date").agg(
        F.max_by(F.struct("promotion_id", "campaign_cost"), F.struct("start_date", "promotion_id")).alias("c")
    ).select(
        "restaurant_id",
        "business_date",
        F.col("c.promotion_id").alias("promotion_id"),
        F.col("c.campaign_cost").alias("campaign_cost"),
    )


@dataclass
class Facts:
    """Clean canonical facts and dimensions."""

    restaurants: DataFrame
    calendar: DataFrame
    transactions: DataFrame
    labour: DataFrame
    waste: DataFrame
    customer_feedback: DataFrame
    delivery: DataFrame
    operating_costs: DataFrame
    promotions: DataFrame
    products: DataFrame | None = None
    targets: DataFrame | None = None
    loyalty: DataFrame | None = None


def spine(restaurants: DataFrame, cal: DataFrame) -> DataFrame:
    """Sites x calendar days on the shared state."""
    days = unique_on(cal, ["business_date", "state"])
    return unique_on(restaurants, "restaurant_id").join(broadcast_if_small(days), "state")


# ---------------------------------------------------------------- J02 / A10
def store_day(f: Facts, orders_mart: DataFrame | None = None) -> DataFrame:
    """Daily profit ledger at (restaurant_id, business_date)."""
    om = orders_mart if orders_mart is not None else orders(f.transactions)
    keys = ["restaurant_id", "business_date"]
    daily = spine(f.restaurants, f.calendar).drop("month")
    for part in (
        sales_day(om),
        roster_day(f.labour),
        waste_day(f.waste),
        feedback_day(f.customer_feedback),
        delivery_day(f.delivery, om),
    ):
        daily = daily.join(part, keys, "left")
    daily = daily.withColumn("month", month_text("business_date"))
    daily = daily.join(monthly_overheads(f.operating_costs), ["restaurant_id", "month"], "left")
    daily = daily.withColumn(
        "overhead_cost", F.col("monthly_overheads") / days_in_month("business_date")
    )
    camp = campaign_days(f.promotions)
    daily = daily.join(camp, keys, "left").withColumn(
        "campaign_cost", F.coalesce(F.col("campaign_cost"), F.lit(0.0))
    )
    daily = daily.fillna(0, subset=ADDITIVE_DAY)
    daily = daily.withColumn(
        "operating_profit", F.col("revenue") - null_sum(*COSTS)
    ).withColumn("satisfaction_score", ratio("score_sum", "survey_responses"))
    return daily


# ---------------------------------------------------------------- H01
def allocate_hours(
    shifts: DataFrame,
    start: str,
    end: str,
    paid: Column,
    extra: dict[str, Column] | None = None,
    hours: tuple[int, int] = TRADING_HOURS,
) -> DataFrame:
    """Spread each shift's paid hours uniformly over the clock hours it overlaps.

    Interval-to-bucket as explode + equi-grain: every shift becomes one row per
    touched hour (at most the shift length + 1), so no range join is needed.
    Returns (restaurant_id, business_date, hour, paid_alloc, *extra) per shift-hour.
    """
    lo, hi = hours
    midnight = F.col("business_date").cast("timestamp_ntz")
    # hours since midnight of the business date, so a shift past midnight reaches 24 and beyond
    begin, finish = (F.timestamp_diff("SECOND", midnight, F.col(c)) / 3600.0 for c in (start, end))
    s = shifts.withColumns({"_begin": begin, "_finish": finish, "_paid": paid})
    first = F.greatest(F.lit(lo), F.floor("_begin").cast("int"))
    last = F.least(F.lit(hi), F.floor("_finish").cast("int"))
    # a shift wholly outside the trading hours has no bucket (a sequence would run backwards)
    s = s.withColumn("hour", F.explode(F.when(first <= last, F.sequence(first, last))))
    overlap = F.greatest(
        F.least(F.col("_finish"), F.col("hour") + 1.0) - F.greatest(F.col("_begin"), F.col("hour").cast("double")),
        F.lit(0.0),
    )
    # a shift of no length overlaps nothing
    alloc = F.coalesce(ratio(overlap * F.col("_paid"), F.col("_finish") - F.col("_begin")), F.lit(0.0))
    cols = [F.col("restaurant_id"), F.col("business_date"), F.col("hour"), alloc.alias("paid_alloc")]
    for name, c in (extra or {}).items():
        cols.append(c.alias(name))
    return s.select(*cols)


def hourly_capacity(labour: DataFrame) -> DataFrame:
    """Actual paid, service hours and cost per (site, date, hour)."""
    a = allocate_hours(
        labour,
        "actual_start",
        "actual_end",
        F.col("paid_hours"),
        {"_service": F.col("role") == "Service", "_rate": F.col("hourly_cost")},
    )
    # hour fractions are rationals with at most 5 decimal places when they
    # terminate, so snapping to micro-hours removes only float noise
    return a.groupBy("restaurant_id", "business_date", "hour").agg(
        snap(F.sum("paid_alloc")).alias("paid_hours"),
        snap(F.sum(F.when(F.col("_service"), F.col("paid_alloc")).otherwise(0.0))).alias("service_hours"),
        snap(F.sum(F.col("paid_alloc") * F.col("_rate"))).alias("labour_cost"),
    )


# ---------------------------------------------------------------- A11 / H03
EPS = 1e-9  # float-noise tolerance on threshold tests of allocated hours


def staffing_status(
    transactions: Column,
    capacity: Column,
    pressure_gap: float | Column = 2.0,
    spare_share: float | Column = 0.45,
) -> Column:
    """Pressure when demand exceeds capacity by more than ``pressure_gap`` orders,
    Spare when demand is under ``spare_share`` of capacity, else Balanced
    (also when capacity is unknown)."""
    return first_match(
        [
            (transactions - capacity > pressure_gap + EPS, "Pressure"),
            (transactions < capacity * spare_share - EPS, "Spare capacity"),
        ],
        "Balanced",
    )


def store_hour(
    daily: DataFrame,
    orders_mart: DataFrame,
    labour: DataFrame,
    orders_per_service_hour: float = 6.0,
    hours: tuple[int, int] = TRADING_HOURS,
) -> DataFrame:
    """Hourly demand against service capacity at (site, date, hour)."""
    lo, hi = hours
    keys = ["restaurant_id", "business_date", "hour"]
    grid = daily.select(
        "restaurant_id", "restaurant_name", "state", "area", "business_date",
        F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("hour"),
    )
    sales = orders_mart.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("transactions"), money_sum("revenue").alias("revenue")
    )
    # a day with any shift has known (possibly zero) capacity in every hour
    staffed = labour.select("restaurant_id", "business_date").distinct().withColumn("_staffed", F.lit(True))
    h = (
        grid.join(sales, keys, "left")
        .join(hourly_capacity(labour), keys, "left")
        .join(staffed, ["restaurant_id", "business_date"], "left")
    )
    h = h.fillna(0, subset=["transactions", "revenue"])
    for c in ("paid_hours", "service_hours", "labour_cost"):
        h = h.withColumn(c, F.when(F.col("_staffed"), F.coalesce(F.col(c), F.lit(0.0))))
    h = h.drop("_staffed")
    cap = F.col("service_hours") * orders_per_service_hour
    return h.select(
        "*",
        cap.alias("service_capacity_orders"),
        (F.col("transactions") - cap).alias("capacity_gap_orders"),
        staffing_status(F.col("transactions"), cap).alias("staffing_status"),
        weekday("business_date").alias("weekday"),
        daypart(F.col("hour")).alias("daypart"),
    )
