"""Report and dashboard feeds: grouped roll-ups over the marts.

All are partial-aggregating ``groupBy`` roll-ups of marts that are already at
site x day (or coarser) grain; peer comparisons subtract a site's own totals
from its peer group's totals instead of pairing sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import broadcast_if_small, money_sum, ratio
from .marts import staffing_status
from .marts import COSTS


def peer_margin_gaps(latest: DataFrame) -> DataFrame:
    """Each site's operating margin against the pooled margin of its location peers
    (same type, not itself): sum profit / sum revenue; the weakest site flagged (A36, J11)."""
    g = latest.groupBy("location_type").agg(
        F.sum("operating_profit").alias("_gp"), F.sum("revenue").alias("_gr"), F.count(F.lit(1)).alias("_n")
    )
    p = latest.join(broadcast_if_small(g), "location_type")
    peer = ratio(F.col("_gp") - F.col("operating_profit"), F.col("_gr") - F.col("revenue"))
    p = p.withColumn("peer_margin_pct", F.when(F.col("_n") > 1, peer))
    weakest = latest.agg(F.min_by("restaurant_id", F.struct("operating_margin_pct", "restaurant_id")).alias("_w"))
    return (
        p.crossJoin(F.broadcast(weakest))  # one row
        .select(
            "restaurant_id", "location_type", "revenue", "operating_profit", "operating_margin_pct",
            "labour_cost_pct", "waste_pct", "peer_margin_pct",
            (F.col("operating_margin_pct") - F.col("peer_margin_pct")).alias("margin_gap"),
            (F.col("restaurant_id") == F.col("_w")).alias("is_weakest"),
        )
    )


def segment_counts(profiles: DataFrame) -> DataFrame:
    """Customers, spend, visits and mean recency per segment."""
    return profiles.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        money_sum("spend").alias("spend"),
        F.sum("visits").alias("visits"),
        F.avg("recency_days").alias("mean_recency_days"),
        F.avg("visits").alias("mean_visits"),
    )


def cohort_rollup(profiles: DataFrame) -> DataFrame:
    """Chain cohort table by first-visit month: customers, eligible, repeaters, rate."""
    g = profiles.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("eligible_90d")).alias("eligible_customers"),
        F.coalesce(F.sum("repeat_within_90d"), F.lit(0)).alias("repeat_customers"),
    )
    return g.withColumn("repeat_rate", ratio("repeat_customers", "eligible_customers"))


def category_month_mix(product_month: DataFrame) -> DataFrame:
    """Revenue, units and contribution per month and category."""
    g = product_month.groupBy("month", "category").agg(
        money_sum("revenue").alias("revenue"), money_sum("ingredient_cost").alias("ingredient_cost"),
        F.sum("units").alias("units"),
    )
    return g.withColumn("gross_contribution", F.col("revenue") - F.col("ingredient_cost"))


def waste_reasons(waste: DataFrame) -> DataFrame:
    """Waste units and cost per reason."""
    return waste.groupBy("reason").agg(
        F.sum("waste_units").alias("waste_units"), money_sum("waste_cost").alias("waste_cost"),
        F.count(F.lit(1)).alias("records"),
    )


def weekly_forecast(forecast_daily: DataFrame) -> DataFrame:
    """Forecast and band totals per site and ISO week."""
    return forecast_daily.groupBy("restaurant_id", F.date_trunc("week", "business_date").cast("date").alias("week_start")).agg(
        F.sum("forecast_revenue").alias("forecast_revenue"), F.sum("lower_80").alias("lower_80"),
        F.sum("upper_80").alias("upper_80"), F.count(F.lit(1)).alias("days"),
    )


def hourly_demand_mix(store_hour: DataFrame) -> DataFrame:
    """Share of all orders in each trading hour, with its daypart."""
    g = store_hour.groupBy("hour", "daypart").agg(F.sum("transactions").alias("orders"))
    total = store_hour.agg(F.sum("transactions").alias("_t"))
    return g.crossJoin(total).select("hour", "daypart", "orders", ratio("orders", "_t").alias("order_share"))


def cost_shares(daily: DataFrame) -> DataFrame:
    """Chain month: each cost line as a share of revenue, and the operating margin (A42 cost-share bridge)."""
    g = daily.groupBy("month").agg(
        money_sum("revenue").alias("revenue"),
        *[F.sum(c).alias(c) for c in COSTS],
        F.sum("operating_profit").alias("operating_profit"),
    )
    return g.select(
        "month", "revenue",
        *[ratio(c, "revenue").alias(f"{c}_share") for c in COSTS],
        ratio("operating_profit", "revenue").alias("operating_margin_pct"),
    )


def forecast_store_totals(forecast_daily: DataFrame) -> DataFrame:
    """Forecast total and days per site."""
    return forecast_daily.groupBy("restaurant_id").agg(
        F.sum("forecast_revenue").alias("forecast_revenue"), F.count(F.lit(1)).alias("days")
    )


def top_anomalies(anomalies: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` largest |robust z| site-days, ties broken by site and date (K02;
    the limit is the feature, a top-k report)."""
    a = anomalies.filter(F.col("robust_z").isNotNull())
    return a.orderBy(F.abs("robust_z").desc(), "restaurant_id", "business_date").limit(k)


def store_dimension(fact: DataFrame) -> DataFrame:
    """Distinct site attributes present in a fact."""
    return fact.select("restaurant_id", "restaurant_name", "state", "location_type", "area").distinct()


def scope_lists(monthly: DataFrame) -> DataFrame:
    """Scope pickers: per state the site list and the months, newest first.
    The sets are bounded by the sites of one state and the months of history."""
    return monthly.groupBy("state").agg(
        F.array_sort(F.collect_set("restaurant_id")).alias("_ids"),
        F.reverse(F.array_sort(F.collect_set("month"))).alias("_months"),
    ).select(
        "state",
        F.array_join(F.col("_ids").cast("array<string>"), ", ").alias("restaurant_ids"),
        F.size("_months").alias("months"),
        F.element_at("_months", 1).alias("latest_month"),
        F.element_at("_months", -1).alias("first_month"),
    )


#: Benchmark orders per service hour, tolerated gap in orders and spare share of the capacity feed.
CAPACITY_CASES = [(6.0, 2.0, 0.45), (5.0, 1.0, 0.50), (8.0, 3.0, 0.40)]


def capacity_thresholds(store_hour: DataFrame, cases: list[tuple[float, float, float]] = CAPACITY_CASES) -> DataFrame:
    """Hours by staffing status per site under each case of benchmark, gap and spare share.

    The cases are an exploded parameter array, so any number of them is one pass and one shuffle."""
    names = ("orders_per_service_hour", "gap_tolerance", "spare_threshold")
    grid = F.array(*(F.struct(*(F.lit(float(v)).alias(n) for n, v in zip(names, case, strict=True))) for case in cases))
    rows = store_hour.select("restaurant_id", "transactions", "service_hours", F.explode(grid).alias("_c")).select("*", "_c.*")
    capacity = F.col("service_hours") * F.col("orders_per_service_hour")
    status = staffing_status(F.col("transactions"), capacity, F.col("gap_tolerance"), F.col("spare_threshold"))
    return rows.withColumn("_s", status).groupBy("restaurant_id", *names).agg(
        F.count(F.lit(1)).alias("hours"), F.count_if(F.col("_s") == "Pressure").alias("pressure_hours"),
        F.count_if(F.col("_s") == "Spare capacity").alias("spare_hours"), F.count_if(F.col("_s") == "Balanced").alias("balanced_hours"),
        ratio(F.count_if(F.col("_s") == "Pressure"), F.count(F.lit(1))).alias("pressure_share"),
    )
