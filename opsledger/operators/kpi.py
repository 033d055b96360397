"""KPI formulas at any grain, monthly KPIs and the Performance Index.

Rates are always recomputed from summed numerators and denominators
(``calculate`` after a ``groupBy.sum``), never averaged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import broadcast_if_small, clamp, money_sum, ratio, unique_on
from .marts import ADDITIVE_DAY, COSTS

# Everything of the daily ledger that may be summed: its facts, its cost lines and the result.
ADDITIVE = [*ADDITIVE_DAY, *(c for c in COSTS if c not in ADDITIVE_DAY), "operating_profit"]

# Performance Index weights (fixed values; must sum to one).
INDEX_WEIGHTS = {"revenue": 0.25, "margin": 0.25, "labour": 0.20, "waste": 0.15, "satisfaction": 0.15}


def calculate(df: DataFrame) -> DataFrame:
    """Gross contribution and ten ratios from additive columns."""
    c = F.col
    return df.withColumns(
        {
            "gross_contribution": c("revenue") - c("ingredient_cost"),
            "average_transaction_value": ratio("revenue", "transactions"),
            "gross_margin_pct": ratio(c("revenue") - c("ingredient_cost"), "revenue"),
            "operating_margin_pct": ratio("operating_profit", "revenue"),
            "labour_cost_pct": ratio("labour_cost", "revenue"),
            "sales_per_labour_hour": ratio("revenue", "paid_hours"),
            "transactions_per_labour_hour": ratio("transactions", "paid_hours"),
            "waste_pct": ratio("waste_cost", c("ingredient_cost") + c("waste_cost")),
            "satisfaction_score": ratio("score_sum", "survey_responses"),
            "identified_order_share": ratio("identified_orders", "transactions"),
            "late_delivery_pct": ratio("late_deliveries", "deliveries"),
        }
    )


# ledger columns that hold whole cents (summed exactly)
MONEY = {"revenue", "ingredient_cost", "discounts", "labour_cost", "waste_cost", "commission_cost"}


def additive_sums(cols: list[str] | None = None) -> list:
    return [(money_sum(x) if x in MONEY else F.sum(x)).alias(x) for x in (cols or ADDITIVE)]


def sum_additive(df: DataFrame, keys: list[str], extra: list[str] | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(*additive_sums(ADDITIVE + (extra or [])))


def aggregate_all(daily: DataFrame) -> DataFrame:
    """Whole-population totals, then rates (A22). One row."""
    return calculate(daily.agg(*additive_sums()))


def growth(df: DataFrame, entity: str, order: str, value: str = "revenue") -> DataFrame:
    """Month-over-month and year-over-year growth by row offset.

    Correct on a gap-free monthly spine; the window holds one entity's months.
    """
    w = Window.partitionBy(entity).orderBy(order)
    lag1, lag12 = F.lag(value, 1).over(w), F.lag(value, 12).over(w)
    return df.withColumns(
        {
            f"{value}_growth_mom": ratio(F.col(value) - lag1, lag1),
            f"{value}_growth_yoy": ratio(F.col(value) - lag12, lag12),
        }
    )


def scores(df: DataFrame, weights: dict[str, float] = INDEX_WEIGHTS) -> DataFrame:
    """Five 0-100 component scores and the weighted Performance Index."""
    if abs(sum(weights.values()) - 1.0) > 1e-9:
        raise ValueError("Performance index weights must sum to one")
    c = F.col
    out = df.withColumns(
        {
            "target_achievement_pct": ratio("revenue", "revenue_target"),
        }
    ).withColumns(
        {
            "score_revenue": clamp(100 * c("target_achievement_pct"), 0, 100),
            "score_margin": clamp(100 * ratio("operating_margin_pct", "operating_margin_target"), 0, 100),
            "score_labour": clamp(100 * ratio("labour_pct_target", "labour_cost_pct"), 0, 100),
            "score_waste": clamp(
                F.when(c("waste_pct") == 0, F.lit(100.0)).otherwise(100 * ratio("waste_pct_target", "waste_pct")),
                0,
                100,
            ),
            "score_satisfaction": clamp(100 * ratio("satisfaction_score", "satisfaction_target"), 0, 100),
        }
    )
    parts = [f"score_{k}" for k in weights]
    complete = F.lit(True)
    for p in parts:
        complete = complete & c(p).isNotNull()
    index = sum((c(f"score_{k}") * w for k, w in weights.items()), F.lit(0.0))
    return out.withColumn("index_complete", complete).withColumn(
        "performance_index", F.when(c("index_complete"), index)
    )


def store_month_kpis(daily: DataFrame, targets: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Monthly KPIs per site with targets, growth and Performance Index."""
    monthly = calculate(sum_additive(daily, ["restaurant_id", "month"]))
    # a month without a target stays, its achievement and index null
    keys = ["restaurant_id", "month"]
    monthly = monthly.join(unique_on(targets, keys), keys, "left").join(
        broadcast_if_small(unique_on(restaurants, "restaurant_id")), "restaurant_id"
    )
    monthly = growth(monthly, "restaurant_id", "month")
    return scores(monthly)


def store_totals(daily: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Full-history site totals with rates."""
    sites = broadcast_if_small(unique_on(restaurants, "restaurant_id"))
    return calculate(sum_additive(daily, ["restaurant_id"])).join(sites, "restaurant_id")
